"""Queries of probe and adapter search, the core pipeline, variants, fusions and ingress; registered in the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators import adapters, barcodes, fusions, kits, probes, reduction, summaries, tagging, variants
from cytoframe.operators.matrix import Matrix
from cytoframe.plans import pipeline, views
from cytoframe.plans.catalogue import REGION, _correction_sql, _matrix, query
from cytoframe.plans.views import t
from cytoframe.sources import alignments, annotation, fastq, ingress
from cytoframe.sources.scratch import dealt_by_rows, scratch_path, written
from cytoframe.streaming import ingest

# ---- probes and adapters -------------------------------------------------------------------------------------------------------
BARCODE, UMI = "case when length(cr) = 16 then cr else concat(cr, 'ACG') end", "substr(concat(ur, 'A'), 1, 12)"
LEAD, BODY = "repeat('A', cast(read_id % 7 as int))", "repeat('GA', cast(20 + read_id % 5 as int))"
MOLECULE = f"concat({LEAD}, 'CTTCCGATCT', {BARCODE}, {UMI}, repeat('T', 12), {BODY})"


@query(f"select read_id, {BARCODE} as \"CR\", {UMI} as \"UR\", repeat('I', 16) as \"CY\", repeat('I', 12) as \"UY\", cast(0 as int) as adapter1_ed, cast(length({MOLECULE}) - (read_id % 7 + 48 - 12) as int) as rest from reads")
def probe_extract(s, d):
    """Molecules built around each read's barcode and UMI, sequenced from the other end; the probe finds both again."""
    r = views.reads(s, d)
    molecule = F.expr(MOLECULE)
    reads = r.select("read_id", seq.reverse_complement(molecule).alias("seq"), F.repeat(F.lit("I"), F.length(molecule)).alias("qual"))
    return probes.extract_barcodes(reads, kits.Kit("3prime")).select("read_id", "CR", "UR", "CY", "UY", "adapter1_ed", F.length("seq").alias("rest"))


A1, A2 = kits.ADAPTER1, kits.Kit("3prime").adapters()["adapter2_f"]
WRONG = A1[:9] + "A" + A1[10:]
HIT_READ = f"concat(repeat('A', cast(5 + read_id % 9 as int)), case when read_id % 2 = 0 then '{A1}' else '{WRONG}' end, repeat('A', 30), case when read_id % 3 = 0 then '' else '{A2}' end, repeat('A', 12))"


@query(
    f"with x as (select read_id, {HIT_READ} as seq from reads) select read_id as query, 'adapter1_f' as target, round(case when read_id % 2 = 0 then 1.0 else 1 - 1 / 22 end, 6) as identity, cast(6 + read_id % 9 as bigint) as qilo, cast(27 + read_id % 9 as bigint) as qihi, cast(length(seq) as bigint) as ql from x "
    "union all select read_id, 'adapter2_f', 1.0, cast(27 + read_id % 9 + 31 as bigint), cast(27 + read_id % 9 + 30 + 27 as bigint), cast(length(seq) as bigint) from x where read_id % 3 <> 0"
)
def adapter_search(s, d):
    """Reads with the first adapter (one base of it changed in every second) and, in two of three, the second."""
    found = adapters.search(views.reads(s, d).select("read_id", F.expr(HIT_READ).alias("seq")), kits.Kit("3prime").adapters())
    return found.withColumn("identity", F.round("identity", 6))


@query("select 0 as i, '>adapter1_f' as line union all select 1, 'CTACACGACGCTCTTCCGATCT' union all select 2, '>adapter1_r' union all select 3, 'AGATCGGAAGAGCGTCGTGTAG' union all select 4, '>adapter2_f' union all select 5, 'GTACTCTGCGTTGATACCACTGCTT' union all select 6, '>adapter2_r' union all select 7, 'AAGCAGTGGTATCAACGCAGAGTAC'")
def adapter_fasta(s, d):
    lines = [x for name, a in kits.Kit("5prime").adapters().items() for x in (f">{name}", a)]
    return s.createDataFrame(list(enumerate(lines)), "i int, line string")


# ---- core pipeline --------------------------------------------------------------------------------------------------------------
def _tags(s, d):
    """Reads with their corrected barcode, written once."""
    r = written(views.reads(s, d).select("read_id", "gene", "chr", "start", "cr", "ur"), "reads")
    with dealt_by_rows(s, r.count()):
        corrected = barcodes.correct(r, views.whitelist(s, d), barcode_length=16).select("cr", F.coalesce("cb", F.lit("-")).alias("CB"))
        rows = written(r.join(corrected, "cr").select("read_id", "chr", "start", (F.col("start") + 700).alias("end"), "CB", F.col("cr").alias("CR"), F.col("ur").alias("UR")), "tags")
    known = F.when(F.col("gene") == "click", "-").otherwise(F.concat("gene", F.lit("."), F.col("read_id") % 40))
    return rows, r.select("read_id", known.alias("gene"), F.lit("-").alias("transcript"))


PARAMETERS = pipeline.Parameters(expected_cells=100, matrix_min_genes=2, matrix_min_cells=2, matrix_max_mito=100)
GENE = "case when gene = 'click' then '-' else concat(gene, '.', read_id % 40) end"
TAGGED = (
    "with recursive " + _correction_sql(True).removeprefix("with ") + f", tg as (select r.read_id, r.chr, r.start, {GENE} as gene, res.cb, ur from reads r join res using (cr) where res.cb is not null), "
    f"gr as (select *, concat(chr, ':', case when gene = '-' then {REGION} else gene end) as g from tg), n as (select g, cb, ur, count(*) as n from gr group by 1, 2, 3), "
    "e as (select a.g, a.cb, a.ur as u, b.ur as v from n a join n b on a.g = b.g and a.cb = b.cb and a.ur <> b.ur and levenshtein(a.ur, b.ur) <= 2 and a.n >= 2 * b.n - 1), "
    "reach as (select g, cb, ur as u, ur as v from n union select r.g, r.cb, r.u, e.v from reach r join e on r.g = e.g and r.cb = e.cb and r.v = e.u), "
    "ranked as (select r.g, r.cb, r.v as ur, r.u as ub, row_number() over (partition by r.g, r.cb, r.v order by n.n desc, r.u) as k from reach r join n on n.g = r.g and n.cb = r.cb and n.ur = r.u), "
    "um as (select gr.*, ranked.ub from gr join ranked using (g, cb, ur) where k = 1 and length(ranked.ub) = 12), mx as (select gene as feature, cb as cell, count(distinct concat(chr, '|', ub)) as value from um where gene <> '-' group by 1, 2)"
)


@query(TAGGED + " select feature, cell, value from mx")
def pipeline_raw_matrix(s, d):
    """Barcode correction, features, UMI clustering and counting in one run."""
    tags, features = _tags(s, d)
    with dealt_by_rows(s, tags.count()):
        rows = written(pipeline.with_umis(written(pipeline.known_tags(tags, features), "known"), PARAMETERS), "expression")
    return pipeline.matrix_of(rows).values


PROCESSED = TAGGED + ", kc as (select cell from mx group by 1 having count(*) >= 2), kf as (select feature from mx group by 1 having count(*) >= 2), km as (select * from mx where cell in (select cell from kc) and feature in (select feature from kf)), tt as (select cell, sum(value) as total from km group by 1)"


@query(PROCESSED + " select feature, cell, round(log10(1 + value * 10000.0 / total), 6) as value from km join tt using (cell)")
def pipeline_processed_matrix(s, d):
    tags, features = _tags(s, d)
    return pipeline.run(tags, features, PARAMETERS)["processed"].values.withColumn("value", F.round("value", 6))


@query("select m.feature, m.cell, m.value from (select case when gene = 'G100' then '-' else gene end as feature, cb as cell, count(distinct ub) as value from tags group by 1, 2) m where m.feature <> '-'")
def matrix_remove_unknown(s, d):
    tags = views.tags(s, d).withColumn("gene", F.when(F.col("gene") == "G100", "-").otherwise(F.col("gene")))
    return Matrix.from_tags(tags, unknown=True).kept().remove_unknown(strict=True).values


@query()
def matrix_principal_components(s, d):
    """Five components of the normalised matrix; held against a dense decomposition in the tests."""
    return reduction.components(_matrix(s, d).kept().normalize(10_000.0).log_transform().kept(), 5)


@query(
    "with tot as (select cell, sum(value) as total, sum(case when contains(feature, 'MT-') then value else 0 end) as mito, coalesce(sum(value) filter (feature = 'G100'), 0) as g, coalesce(sum(value) filter (feature = 'MT-3'), 0) as m from matrix group by 1) "
    "select cell, length(cell) as x, round(total / (select count(distinct feature) from matrix), 6) as mean_expression, round(mito / total, 6) as mito_share, cast(g as bigint) as \"G100\", cast(m as bigint) as \"MT-3\" from tot"
)
def cell_table(s, d):
    """Cells of an embedding with their expression, mitochondrial share and genes of interest."""
    m = _matrix(s, d).kept()
    out = summaries.cell_table(m, m.cells.withColumn("x", F.length("cell")), ["G100", "MT-3"], ["MT-"])
    return out.select("cell", "x", F.round("mean_expression", 6).alias("mean_expression"), F.round("mito_share", 6).alias("mito_share"), "G100", "MT-3")


@query("select r.read_id, r.chr, b.cr, case when s.read_id is not null then cast(r.read_id as varchar) else '-' end as \"SA\" from reads r left join (select read_id, cr from reads where length(cr) = 16) b on r.read_id = b.read_id left join (select distinct l_orderkey as read_id from lineitem) s on r.read_id = s.read_id")
def mappings_with_barcodes(s, d):
    """Every mapping keeps its row; barcodes and split alignments are joined where they exist."""
    r = views.reads(s, d)
    return tagging.with_barcodes(r.select("read_id", "chr"), r.where("length(cr) = 16").select("read_id", "cr"), t(s, d, "lineitem").select(F.col("l_orderkey").alias("read_id")))


# ---- alignments -----------------------------------------------------------------------------------------------------------------
@query("select read_id, part, case part when 0 then start else start + 110 end as start, case part when 0 then start + 10 else start + 133 end as \"end\", case part when 0 then '2S10M' else '20M5I3D' end as cigar, case part when 0 then substr(cr, 1, 12) else substr(cr, 13, 25) end as seq from reads, (select unnest([0, 1]) as part)")
def cigar_split(s, d):
    """Alignments with one junction fall into two blocks."""
    a = views.reads(s, d).select("read_id", "start", F.lit("2S10M100N20M5I3D").alias("cigar"), F.col("cr").alias("seq"), F.lit("*").alias("qual"))
    return alignments.split_at_junctions(a).select("read_id", "part", "start", "end", "cigar", "seq")


@query()
def depth_clip(s, d):
    """Reads of deep genes thinned; which ones stay is drawn, so the tests hold it against its rule."""
    r = views.reads(s, d)
    return alignments.clip_depth(r.select("read_id", "gene"), r.where("gene = 'click'").select("read_id", F.lit(400.0).alias("depth")), 100.0)


@query("select cast(l_orderkey * 10 + l_linenumber as varchar) as read_id, concat('tr', l_partkey) as query_transcript, cast(l_quantity as int) as aln_score, round((cast(l_quantity as bigint) + 20) / 200.0, 6) as tr_cov, round((cast(l_quantity as bigint) + 10) / (cast(l_quantity as bigint) + 15.0), 6) as q_cov, cast(l_linenumber as int) as tr_mapq from lineitem where l_linestatus = 'O'")
def transcript_alignment_scores(s, d):
    """Alignments to transcripts written as SAM with their references, read back and scored; unmapped ones go."""
    path = scratch_path(s, "transcripts")
    x = t(s, d, "lineitem")
    chrom = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("tr"), "l_partkey")).otherwise("*")
    q = F.col("l_quantity").cast("int").cast("string")
    rows = x.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("read_id"), F.lit(0).alias("flag"), chrom.alias("chr"), F.lit(5).alias("start"), F.col("l_linenumber").alias("mapq"), F.concat(F.lit("5S"), q, F.lit("M10N5I5D5=")).alias("cigar"), F.lit("*").alias("seq"), F.lit("*").alias("qual"), F.create_map(F.lit("AS"), q).alias("tags"))
    alignments.write_sam(rows, f"{path}/body")
    x.select("l_partkey").distinct().select(F.concat(F.lit("@SQ\tSN:tr"), "l_partkey", F.lit("\tLN:200")).alias("value")).write.text(f"{path}/head")
    out = alignments.transcript_alignments(alignments.read_sam(s, f"{path}/body"), alignments.read_references(s, f"{path}/head"))
    return out.withColumn("tr_cov", F.round("tr_cov", 6)).withColumn("q_cov", F.round("q_cov", 6))


@query("select chr from (select distinct concat('chr', r_regionkey) as chr from region) union all select '*'")
def header_chromosomes(s, d):
    path = scratch_path(s, "header")
    t(s, d, "region").select(F.concat(F.lit("@SQ\tSN:chr"), "r_regionkey", F.lit("\tLN:1000")).alias("value")).write.text(path)
    return alignments.chromosomes(alignments.read_references(s, path))


@query("select concat('chr', user_id % 3) as chrom, (event_id % 50000) as start, (event_id % 50000) + 300 as \"end\", 'tr' as kind, event_id as id from events")
def junction_introns(s, d):
    """Introns of transcripts of two exons, from GTF text."""
    path = scratch_path(s, "exons")
    e = t(s, d, "events")
    at = F.col("event_id") % 50000
    line = lambda a, b: F.concat_ws("\t", F.concat(F.lit("chr"), F.col("user_id") % 3), F.lit("x"), F.lit("exon"), a, b, F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit('transcript_id "'), F.col("event_id"), F.lit('";')))
    e.select(F.explode(F.array(line(at - 99, at), line(at + 301, at + 350))).alias("value")).write.text(path)
    return annotation.junctions(s, path).select(F.col("chr").alias("chrom"), "start", "end", F.lit("tr").alias("kind"), F.col("transcript").cast("long").alias("id"))


# ---- variants -------------------------------------------------------------------------------------------------------------------
SITE = "select concat('c', l_suppkey % 3) as chrom, l_partkey % 300 * 17 + 1 as pos, case when l_partkey % 2 = 0 then 'A' else 'AC' end as ref, case when l_partkey % 2 = 0 then 'G,T' else 'AG' end as alt from lineitem"


@query(f"with x as (select distinct chrom, pos, ref, alt from ({SITE})), y as (select chrom, pos, ref, unnest(string_split(alt, ',')) as alt from x) select distinct chrom, case when length(ref) = 2 then pos + 1 else pos end as pos, case when length(ref) = 2 then 'C' else ref end as ref, case when length(ref) = 2 then 'G' else alt end as alt from y")
def variant_sites(s, d):
    """Sites of two tables merged, split by alternative and cut into single bases."""
    t(s, d, "lineitem").createOrReplaceTempView("lineitem")
    sites = s.sql(SITE)
    return variants.merged_sites(sites.where("pos % 2 = 0"), sites.where("pos % 2 = 1"))


CALLS = "select concat('c', l_suppkey % 3) as chrom, l_partkey % 300 * 17 + 1 as pos, concat('s', l_linenumber) as sample, max(case l_orderkey % 4 when 0 then '0/0' when 1 then '0/1' when 2 then '1|1' else './.' end) as gt from lineitem group by 1, 2, 3"
CODED = f"with g as (select *, concat_ws('_', chrom, pos, 'A', 'G') as variant, case when contains(gt, '.') then -1 else cast(substr(gt, 1, 1) as int) + cast(substr(gt, 3, 1) as int) end as code from ({CALLS})), grid as (select v.*, concat('s', unnest([1, 2, 3, 4, 5, 6, 7])) as sample from (select distinct chrom, pos, variant from g) v), f as (select grid.*, coalesce(g.code, -1) as code from grid left join g using (variant, sample)) "
ORDERED = "row_number() over (order by case chrom when 'c2' then 0 when 'c0' then 1 else 2 end, pos, variant)"


def _calls(s, d):
    """Genotypes written as VCF text, one column a sample, and read back."""
    path = scratch_path(s, "vcf")
    t(s, d, "lineitem").createOrReplaceTempView("lineitem")
    names = [f"s{i}" for i in range(1, 8)]
    wide = s.sql(CALLS).groupBy("chrom", "pos").pivot("sample", names).agg(F.max("gt")).na.fill("./.")
    s.createDataFrame([("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(names),)], "value string").union(wide.select(F.concat_ws("\t", "chrom", "pos", F.lit("."), F.lit("A"), F.lit("G"), F.lit("."), F.lit("."), F.lit("."), F.lit("GT"), *names))).coalesce(1).write.text(path)
    return variants.coded(annotation.read_genotypes(s, path)), names


@query(CODED + "select variant, sample, code, case code when -1 then 'no_data' when 0 then 'hom-ref' when 1 then 'het' else 'hom-alt' end as label from f")
def vcf_scan(s, d):
    calls, _ = _calls(s, d)
    return calls.select("variant", "sample", "code", variants.label(F.col("code")).alias("label"))


@query(CODED + f", o as (select variant, {ORDERED} as r from (select distinct chrom, pos, variant from f)) select o.r as row, cast(substr(sample, 2) as bigint) as col, code as value from f join o using (variant) where code >= 0")
def genotype_exchange(s, d):
    """Triples of the genotype matrix in file order of the variants and header order of the samples."""
    calls, names = _calls(s, d)
    return variants.genotype_triples(calls, ["c2", "c0"], names)


@query(CODED + f", o as (select variant, {ORDERED} as r from (select distinct chrom, pos, variant from f)) select variant, max(code) filter (sample = 's1') as s1, max(code) filter (sample = 's2') as s2 from f join o using (variant) where r <= 50 group by 1")
def genotype_report(s, d):
    """The first fifty variants in file order."""
    calls, _ = _calls(s, d)
    return variants.report_table(calls, ["c2", "c0"], ["s1", "s2"])


# ---- fusions --------------------------------------------------------------------------------------------------------------------
FUSIONS = "select concat('F', o_custkey % 200) as \"FusionName\", concat('L', o_custkey % 200) as \"LeftGene\", concat('chr', o_custkey % 4) as \"LeftBreakpoint\", concat('R', o_custkey % 200) as \"RightGene\", o_orderpriority as \"RightBreakpoint\", o_orderstatus as \"SpliceType\", concat_ws(',', cast(o_orderkey as string), cast(o_orderkey + 1 as string), cast(o_custkey as string)) as \"LR_accessions\" from orders"
ROWS = f"with x as (select * exclude (\"LR_accessions\"), cast(unnest(string_split(\"LR_accessions\", ',')) as bigint) as read_id from ({FUSIONS})), j as (select x.*, user_id as cb, event_type as ub from x join events on read_id = event_id)"


def _fusion_rows(s, d):
    t(s, d, "orders").createOrReplaceTempView("orders")
    rows = fusions.read_rows(s.sql(FUSIONS.replace('"', "`")))
    tags = t(s, d, "events").select(F.col("event_id").cast("string").alias("read_id"), F.col("user_id").alias("CB"), F.col("event_type").alias("UB"))
    return rows, tags


@query(ROWS + " select \"FusionName\" as \"Fusion\", \"LeftGene\", \"LeftBreakpoint\", \"RightGene\", \"RightBreakpoint\", \"SpliceType\", count(distinct cb) as cells, count(distinct ub) as \"UMIs\", 'x' as \"sample_ID\" from j group by all")
def fusion_by_breakpoints(s, d):
    return fusions.per_fusion(fusions.of_cells(*_fusion_rows(s, d)), "x")


@query(ROWS + ", c as (select cb, count(*) as n, count(distinct \"FusionName\") as f from j group by 1) select 'x' as \"sample_ID\", count(*) as cells_with_fusions, (select count(distinct \"FusionName\") from j) as unique_fusions, cast(sum(n) as bigint) as reads, round(avg(n), 6) as mean_fusion_reads_per_cell, round(avg(f), 6) as mean_unique_fusions_per_cell from c")
def fusion_sample_summary(s, d):
    out = fusions.per_sample(fusions.of_cells(*_fusion_rows(s, d)), "x")
    return out.select("sample_ID", "cells_with_fusions", "unique_fusions", "reads", F.round("mean_fusion_reads_per_cell", 6).alias("mean_fusion_reads_per_cell"), F.round("mean_unique_fusions_per_cell", 6).alias("mean_unique_fusions_per_cell"))


@query(ROWS + " select \"FusionName\", cb as \"CB\", cast(read_id as varchar) as read_id, count(*) over (partition by \"FusionName\") as n from j")
def fusion_reads_by_frequency(s, d):
    return fusions.per_read(fusions.of_cells(*_fusion_rows(s, d))).select("FusionName", "CB", "read_id", "n")


@query(ROWS + " select distinct cast(read_id as varchar) as read_id from x where read_id not in (select event_id from events)")
def fusion_reads_without_tags(s, d):
    return fusions.without_tags(*_fusion_rows(s, d))


# ---- ingress and text -----------------------------------------------------------------------------------------------------------
@query("select concat('barcode', lpad(cast(r_regionkey as string), 2, '0')) as sample, 'reads.fastq' as file from region")
def input_discovery(s, d):
    """A folder of samples: other files, unclassified and failed reads are left out."""
    path = scratch_path(s, "inbox")
    names = [r.r_regionkey for r in t(s, d, "region").select("r_regionkey").collect()]
    fs = s._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(s._jsc.hadoopConfiguration())
    for name in [*(f"barcode{k:02d}/reads.fastq" for k in names), "barcode00/notes.txt", "unclassified/reads.fastq", "fastq_fail/reads.fastq"]:
        out = fs.create(s._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
        out.write(bytearray(b"@"))
        out.close()
    return ingress.discover(s, path).select("sample", F.substring_index("path", "/", -1).alias("file"))


@query("select * from (select n_regionkey as sample, count(*) as n_seqs, [concat('run', n_regionkey)] as run_ids, list_sort(list(distinct concat('model', n_nationkey % 2))) as basecallers from nation group by 1)")
def run_information(s, d):
    """Run ids and basecallers from FASTQ comments."""
    path = scratch_path(s, "runs")
    n = t(s, d, "nation")
    head = F.concat(F.lit("@r"), "n_nationkey", F.lit(" runid=run"), "n_regionkey", F.lit(" basecall_model_version_id=model"), F.col("n_nationkey") % 2, F.lit(" region="), "n_regionkey")
    n.select(F.concat_ws("\n", head, F.lit("ACGT"), F.lit("+"), F.lit("IIII")).alias("value")).write.text(path)
    reads = fastq.read_fastq(s, path).select(F.regexp_extract("comment", "region=([0-9]+)", 1).cast("int").alias("sample"), "comment")
    return summaries.run_info(reads).withColumn("sample", F.col("sample").cast(n.schema["n_regionkey"].dataType))


@query("select 'an alias repeats' as fault union all select 'a barcode is not ''barcode'' and two digits or more' union all select 'no sample of type positive_control' union all select 'barcodes differ in length'")
def sheet_validation(s, d):
    """The regions as a sheet that breaks four rules, written as CSV and read back."""
    path = scratch_path(s, "sheet")
    k = F.col("r_regionkey")
    rows = t(s, d, "region").select(F.when(k == 1, "bar1").otherwise(F.concat(F.lit("barcode0"), k)).alias("barcode"), F.when(k < 2, "one").otherwise(F.col("r_name")).alias("alias"), F.lit("test_sample").alias("type"))
    rows.coalesce(1).write.option("header", True).csv(path)
    return annotation.sheet_faults(annotation.read_sheet(s, path), required_types=("positive_control", "test_sample"))


@query("select concat('barcode', lpad(cast(n_nationkey as string), 2, '0')) as barcode, n_name as alias, case when n_nationkey % 3 = 0 then n_name when n_nationkey % 3 = 1 then concat('barcode', lpad(cast(n_nationkey as string), 2, '0')) end as folder, case when n_nationkey % 3 = 0 then 'alias' when n_nationkey % 3 = 1 then 'barcode' end as matched from nation")
def sheet_join(s, d):
    """Folders named by alias or barcode, a third of the rows without one, and one folder that the sheet lacks."""
    n = t(s, d, "nation")
    k = F.col("n_nationkey")
    sheet = n.select(F.concat(F.lit("barcode"), F.lpad(k.cast("string"), 2, "0")).alias("barcode"), F.col("n_name").alias("alias"))
    folders = n.select(F.when(k % 3 == 0, F.col("n_name")).when(k % 3 == 1, F.concat(F.lit("barcode"), F.lpad(k.cast("string"), 2, "0"))).otherwise("absent").alias("folder")).distinct()
    return annotation.join_sheet(folders, sheet).select("barcode", "alias", "folder", "matched")


@query("select n_name, n_regionkey as analysis_group, count(*) over (partition by n_regionkey) as n_group from nation")
def sheet_groups(s, d):
    return annotation.group_counts(t(s, d, "nation").select("n_name", F.col("n_regionkey").alias("analysis_group")))


@query("select cast(c_nationkey as varchar) as key, cast(sum(c_custkey) as varchar) as total from customer group by c_nationkey")
def tables_with_one_header(s, d):
    """Sums written as one table with one header, and read back."""
    path = scratch_path(s, "once")
    sums = t(s, d, "customer").groupBy(F.col("c_nationkey").alias("key")).agg(F.sum("c_custkey").alias("total"))
    ingress.write_one_header(sums, path)
    lines = s.read.text(f"{path}/*")
    f = F.split("value", "\t")
    return lines.where("value != 'key\ttotal'").select(f[0].alias("key"), f[1].alias("total"))


@query("select 'chr1\tx' as value union all select distinct concat('chr', r_regionkey, '\ty') from region")
def annotation_merge(s, d):
    one = s.createDataFrame([("# head",), ("chr1\tx",)], "value string")
    return ingress.merged_annotation(one, t(s, d, "region").select(F.concat(F.lit("chr"), "r_regionkey", F.lit("\ty")).alias("value")))


@query("select event_type as statistic, cast(2 * count(*) as double) as count from events group by 1")
def statistics_json(s, d):
    """The same statistics of two shards, written as JSON, read back and summed."""
    paths = [scratch_path(s, "stats") for _ in range(2)]
    counts = t(s, d, "events").groupBy(F.col("event_type").alias("statistic")).agg(F.count("*").cast("double").alias("count"))
    for p in paths:
        ingress.write_statistics(counts, p)
    return ingress.read_statistics(s, paths)


@query("select cast(l_returnflag as varchar) as flag, count(*) as n from lineitem group by 1")
def split_by_key(s, d):
    path = scratch_path(s, "split")
    ingress.split_by(t(s, d, "lineitem").select("l_returnflag", "l_orderkey"), "l_returnflag", path)
    return s.read.option("sep", "\t").option("header", True).csv(path).groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"))


@query("select r_name, n.n_name as sample, n.k as place from region join (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_name) - 1 as k from nation) n on r_regionkey = n_regionkey")
def lists_transposed(s, d):
    """A row for each place of two lists of equal length."""
    n = t(s, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("sample"))
    n = n.withColumn("place", F.sequence(F.lit(0).cast("long"), F.size("sample").cast("long") - 1))
    return t(s, d, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey")).select("r_name", F.explode(F.arrays_zip("sample", "place")).alias("x")).select("r_name", "x.sample", "x.place")


@query("select c_custkey, format('{:,}', c_custkey * 1000) || ' reads' as shown, replace(c_name, ' ', '_') as alias from customer")
def report_numbers(s, d):
    return t(s, d, "customer").select("c_custkey", seq.number_text(F.col("c_custkey") * 1000, unit="reads").alias("shown"), ingress.alias(F.col("c_name")).alias("alias"))


# ---- streams --------------------------------------------------------------------------------------------------------------------
def _streamed(s, d):
    """UMIs of the events, taken in as a file stream until all of it is seen."""
    path = scratch_path(s, "umis")
    schema = t(s, d, "events").schema
    tags = ingest.watch(s, d, "events.parquet", schema).select(F.col("event_type").alias("gene"), (F.col("user_id") % 50).cast("string").alias("CB"), (F.col("event_id") % 97).cast("string").alias("UB"))
    ingest.collect_umis(tags, path).option("checkpointLocation", scratch_path(s, "stream")).trigger(availableNow=True).start().awaitTermination()
    return ingest.umis_so_far(s, path)


@query("select event_type as feature, cast(user_id % 50 as varchar) as cell, count(distinct event_id % 97) as value from events group by 1, 2")
def stream_matrix(s, d):
    return ingest.matrix_so_far(_streamed(s, d)).values


@query("select n_reads, n_umis, round(1 - n_umis / n_reads, 6) as saturation from (select cast(count(*) as bigint) as n_reads, count(distinct concat_ws('|', event_type, user_id % 50, event_id % 97)) as n_umis from events)")
def stream_saturation(s, d):
    return ingest.saturation_so_far(_streamed(s, d)).withColumn("saturation", F.round("saturation", 6))
