"""Queries that go through files: tables are written in a format of the domain and read back by its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.plans import views
from cytoframe.plans.catalogue import _matrix, query
from cytoframe.plans.views import t
from cytoframe.sources import alignments, annotation, exchange, fastq
from cytoframe.sources.scratch import scratch_path


@query("select cast(read_id as varchar) as read_id, cr as seq, cy as qual from reads")
def fastq_scan(s, d):
    path = scratch_path(s, "fastq")
    fastq.write_fastq(views.reads(s, d).select(F.col("read_id").cast("string").alias("read_id"), F.col("cr").alias("seq"), F.col("cy").alias("qual")), path)
    return fastq.read_fastq(s, path).select("read_id", "seq", "qual")


@query("select cast(read_id as varchar) as read_id, chr, start, start + 16 as \"end\", cr, case when read_id % 2 = 0 then ur else '-' end as ur from reads where user_id % 5 <> 0")
def sam_tag_scan(s, d):
    """Tagged alignments written as SAM text, read back, and their tags taken out; every fifth user's reads have no barcode."""
    path = scratch_path(s, "sam")
    r = views.reads(s, d)
    rows = r.select(F.col("read_id").cast("string").alias("read_id"), F.lit(0).alias("flag"), "chr", "start", F.lit(60).alias("mapq"), F.lit("2S16M").alias("cigar"), F.lit("*").alias("seq"), F.lit("*").alias("qual"), F.create_map(F.lit("AS"), F.lit("16")).alias("tags"))
    tags = r.select(F.col("read_id").cast("string").alias("read_id"), F.col("cr").alias("CR"), F.when(F.col("user_id") % 5 != 0, F.col("cr")).alias("CB"), F.when(F.col("read_id") % 2 == 0, F.col("ur")).alias("UR"))
    alignments.write_sam(alignments.tag_alignments(rows, tags), path)
    return alignments.extract_tags(alignments.read_sam(s, path)).select("read_id", "chr", "start", "end", F.col("CR").alias("cr"), F.col("UR").alias("ur"))


@query("select feature, cell, cast(value as double) as value from matrix")
def mex_round_trip(s, d):
    path = scratch_path(s, "mex")
    exchange.write_exchange(_matrix(s, d), path)
    return exchange.read_exchange(s, path).values


@query("select concat('ref', p_partkey) as ref_id, case when p_partkey % 7 <> 0 then concat('gene', p_partkey % 60) end as gene_name from part where p_partkey % 3 <> 0")
def gtf_scan(s, d):
    path = scratch_path(s, "gtf")
    k = F.col("p_partkey")
    more = F.concat(F.lit('transcript_id "ref'), k, F.lit('";'), F.when(k % 7 != 0, F.concat(F.lit(' gene_name "gene'), k % 60, F.lit('";'))).otherwise(""))
    kind = F.when(k % 3 == 0, "exon").when(k % 3 == 1, "transcript").otherwise("mRNA")
    t(s, d, "part").select(F.concat_ws("\t", F.lit("chr1"), F.lit("x"), kind, F.lit("1"), F.lit("9"), F.lit("."), F.lit("+"), F.lit("."), more).alias("value")).write.text(path)
    return annotation.read_transcript_genes(s, path)


@query()
def matrix_downsample(s, d):
    """Binomial thinning to a half; random, so the check is on its moments in the tests."""
    return _matrix(s, d).downsample(0.5).values


@query()
def saturation_gene_umi(s, d):
    return _matrix(s, d).saturation_statistics()
