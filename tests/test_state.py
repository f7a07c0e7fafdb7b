"""The stream's matrix equals the batch result: over batches, restarts and batches that run again."""

from pyspark.sql import functions as F

from cytoframe.sources.scratch import scratch_path
from cytoframe.streaming import ingest, state


def rows(spark, a, b):
    k = F.col("id")
    return spark.range(a, b).select(F.when(k % 17 == 0, "-").otherwise(F.concat(F.lit("g"), k % 4)).alias("gene"), F.when(k % 19 == 0, None).otherwise(F.concat(F.lit("c"), k % 3)).alias("CB"), F.concat(F.lit("u"), k * 7 % 29).alias("UB")).coalesce(1)


def wanted(df):
    known = df.where("gene != '-' and CB != '-' and UB != '-'")
    return {(r.gene, r.CB): (r.n_umis, r.n_reads) for r in known.groupBy("gene", "CB").agg(F.countDistinct("UB").alias("n_umis"), F.count("*").alias("n_reads")).collect()}


def test_matrix_state(spark):
    landing, check, out = (scratch_path(spark, x) for x in ("landing", "check", "changes"))
    schema = rows(spark, 0, 1).schema

    def run():
        tags = ingest.watch(spark, landing, "*.parquet", schema, files_a_trigger=1)
        q = state.write_changes(state.umi_changes(tags), out).option("checkpointLocation", check).start()
        q.processAllAvailable()
        q.stop()

    def held():
        return {(r.gene, r.CB): (r.n_umis, r.n_reads) for r in state.entries(spark, check).collect()}

    rows(spark, 0, 200).write.mode("append").parquet(landing)
    run()
    assert held() == wanted(rows(spark, 0, 200))
    rows(spark, 200, 215).write.mode("append").parquet(landing)
    rows(spark, 215, 230).where("gene = 'g1'").write.mode("append").parquet(landing)
    run()
    every = rows(spark, 0, 215).union(rows(spark, 215, 230).where("gene = 'g1'"))
    assert held() == wanted(every)
    changed = spark.read.parquet(out)
    last = max(r.batch for r in changed.select("batch").distinct().collect())
    assert {r.gene for r in changed.where(F.col("batch") == last).collect()} == {"g1"}  # only what the batch touched
    best = changed.groupBy("gene", "CB").agg(F.max_by(F.struct("n_umis", "n_reads"), "batch").alias("x")).select("gene", "CB", "x.*")
    assert {(r.gene, r.CB): (r.n_umis, r.n_reads) for r in best.collect()} == held()
    spark._jvm.org.apache.hadoop.fs.Path(check).getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(f"{check}/commits/{last}"), True)
    run()  # the last batch runs again
    assert held() == wanted(every)
    assert state.matrix(spark, check).values.agg(F.sum("value")).first()[0] == sum(v[0] for v in held().values())
    assert state.umis(spark, check).count() == sum(v[0] for v in held().values())
    one = state.saturation(spark, check).first()
    assert (one.n_umis, one.n_reads) == (sum(v[0] for v in held().values()), sum(v[1] for v in held().values()))


def test_no_python_in_the_stream(spark):
    """Entries and reads of each UMI over two batches; rows of the state are kept by Spark's own operators, at no call of Python."""
    landing, check, out = (scratch_path(spark, x) for x in ("landing", "check", "changes"))
    for a, b in ((0, 300), (150, 500)):
        rows(spark, a, b).write.mode("append").parquet(landing)
    changes = state.umi_changes(ingest.watch(spark, landing, "*.parquet", rows(spark, 0, 1).schema, files_a_trigger=1))
    assert "Pandas" not in changes._jdf.queryExecution().logical().toString()
    q = state.write_changes(changes, out).option("checkpointLocation", check).start()
    q.processAllAvailable()
    q.stop()
    every = rows(spark, 0, 300).union(rows(spark, 150, 500))
    assert {(r.gene, r.CB): (r.n_umis, r.n_reads) for r in state.entries(spark, check).collect()} == wanted(every)
    known = every.where("gene != '-' and CB != '-' and UB != '-'").groupBy("gene", "CB", "UB").count()
    assert sorted(map(tuple, state.umis(spark, check).collect())) == sorted(map(tuple, known.collect()))
