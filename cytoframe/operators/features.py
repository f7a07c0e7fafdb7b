"""Gene and transcript assignment of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_features(aln: DataFrame, tmap: DataFrame, annotation: DataFrame, genome: DataFrame, *, min_mapq: int = 30, min_cov: float = 0.4) -> DataFrame:
    """Reads with their gene and transcript, '-' where unknown; reads with neither are left out.

    A read with one alignment keeps its transcript; one with several keeps the best by score and coverages where the best is clearly
    better and covers enough; its gene is that of the best genomic mapping.
    """
    j = aln.join(tmap, F.col("query_transcript") == F.col("qry_id")).join(annotation, "ref_id").join(genome, "read_id")
    j = j.withColumn("transcript", F.when(F.col("class_code").isin("i", "y", "p", "s"), "-").otherwise(F.col("ref_id"))).withColumn("gene", F.coalesce("gene_name", F.lit("-")))
    j = j.withColumn("_n", F.count("*").over(Window.partitionBy("read_id")))
    weak = lambda c: F.when(F.col("mapq") < min_mapq, "-").otherwise(F.col(c))
    unique = j.where("_n = 1 and tr_mapq > 0").select("read_id", weak("gene").alias("gene"), "transcript")
    best = Window.partitionBy("read_id").orderBy(F.desc("aln_score"), F.desc("q_cov"), F.desc("tr_cov"), "query_transcript")
    mapped = Window.partitionBy("read_id").orderBy(F.desc("mapq"), F.desc("aln_score"), F.desc("q_cov"), F.desc("tr_cov"), "query_transcript")
    m = j.where("_n > 1").select("*", F.row_number().over(best).alias("_r"), *[F.lead(c).over(best).alias(f"_{c}") for c in ("aln_score", "q_cov", "tr_cov")], F.first(weak("gene")).over(mapped).alias("_gene")).where("_r = 1")
    differs = (F.col("aln_score") != F.col("_aln_score")) | (F.col("q_cov") != F.col("_q_cov"))
    covers = (F.col("tr_cov") >= min_cov) & (F.col("q_cov") >= min_cov)
    longer = (F.col("tr_cov") != F.col("_tr_cov")) & (F.col("tr_cov") > 0.8)
    multi = m.select("read_id", F.col("_gene").alias("gene"), F.when((differs & covers) | (~differs & longer), F.col("transcript")).otherwise("-").alias("transcript"))
    return unique.unionByName(multi).where("gene != '-' or transcript != '-'")
