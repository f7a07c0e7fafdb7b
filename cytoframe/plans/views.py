"""Domain views over the driver's tables, in Spark and, as text, in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEX, BASES = "0123456789abcdef", "ACGTACGTACGTACGT"


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dna(x: str) -> str:
    """SQL of 32 bases that depend on an expression; both engines read it alike."""
    return f"translate(md5(cast({x} as string)), '{HEX}', '{BASES}')"


def duck(sql: str) -> str:
    return sql.replace(" as string)", " as varchar)")


CB = f"substr({dna("concat('cb', user_id)")}, 1, 16)"
READS_SQL = f"""select event_id as read_id, user_id, event_type as gene, concat('chr', cast(user_id % 3 as string)) as chr, event_id % 50000 as start,
 case when event_id % 23 = 5 then substr(c, 1, 13) else case event_id % 20 when 0 then concat(translate(substr(c, 1, 1), 'ACGT', 'CGTA'), substr(c, 2)) when 1 then concat(substr(c, 1, 8), translate(substr(c, 9, 1), 'ACGT', 'GTAC'), substr(c, 10))
 when 2 then concat(substr(c, 1, 3), translate(substr(c, 4, 1), 'ACGT', 'CGTA'), substr(c, 5, 8), translate(substr(c, 13, 1), 'ACGT', 'TACG'), substr(c, 14))
 when 3 then substr({dna("concat('x', event_id)")}, 1, 16) else c end end as cr,
 case when event_id % 11 = 3 then concat(substr(u, 1, 5), substr(u, 7)) when event_id % 13 = 4 then concat(substr(u, 1, 4), 'A', substr(u, 5)) else case event_id % 7 when 0 then concat(substr(u, 1, 5), translate(substr(u, 6, 1), 'ACGT', 'CGTA'), substr(u, 7)) else u end end as ur,
 substr(translate(md5(cast(concat('q', event_id) as string)), '{HEX}', '-5:?ADFGIKLMNOPQ'), 1, 16) as cy
 from (select *, {CB} as c, substr({dna("concat('u', event_id % 97)")}, 1, 12) as u from events)"""
TAGS_SQL = "select concat(case when l_partkey % 400 < 20 then 'MT-' else 'G' end, cast(l_partkey % 400 as string)) as gene, concat('c', cast(l_suppkey as string)) as cb, l_orderkey as ub, l_returnflag as chr, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem where l_quantity > 1 and l_linestatus is not null"
MATRIX_SQL = "select gene as feature, cb as cell, count(distinct ub) as value from tags where gene <> '-' group by 1, 2"


def reads(spark: SparkSession, d: str) -> DataFrame:
    t(spark, d, "events").createOrReplaceTempView("events")
    return spark.sql(READS_SQL)


def tags(spark: SparkSession, d: str) -> DataFrame:
    t(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(TAGS_SQL)


def whitelist(spark: SparkSession, d: str) -> DataFrame:
    t(spark, d, "events").createOrReplaceTempView("events")
    return spark.sql(f"select distinct {CB} as barcode from events")


HITS_SQL = "select concat('r', cast(event_id div 4 as string), case user_id % 3 when 0 then 'b' else 'a' end) as query, case (user_id + event_id) % 5 when 0 then 'adapter1_f' when 1 then 'adapter2_f' when 2 then 'adapter2_r' when 3 then 'adapter1_r' else 'adapter1_f' end as target, (event_id % 4) * 200 + 1 + user_id % 50 as qilo, (event_id % 4) * 200 + 22 + user_id % 50 as qihi, 1000 as ql from events"


def hits(spark: SparkSession, d: str) -> DataFrame:
    """Adapter hits of every event: one to four a query, as blocks of four events fall into two queries by user."""
    t(spark, d, "events").createOrReplaceTempView("events")
    return spark.sql(HITS_SQL)


INTERVALS_SQL = "select concat('chr', cast(o_custkey % 4 as string)) as chrom, (o_orderkey * 37) % 200000 as start, (o_orderkey * 37) % 200000 + 50 + o_custkey % 300 as \"end\", o_orderkey as id from orders"


def intervals(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders")
    at = (F.col("o_orderkey") * 37) % 200000
    return o.select(F.concat(F.lit("chr"), (F.col("o_custkey") % 4).cast("string")).alias("chrom"), at.alias("start"), (at + 50 + F.col("o_custkey") % 300).alias("end"), F.col("o_orderkey").alias("id"))


EVENT_INTERVALS_SQL = "select concat('chr', cast(user_id % 4 as string)) as chrom, (event_id * 53) % 200000 as start, (event_id * 53) % 200000 + 1 + user_id % 40 as \"end\", event_id as id from events"


def event_intervals(spark: SparkSession, d: str) -> DataFrame:
    """A second table of intervals, one an event."""
    at = (F.col("event_id") * 53) % 200000
    return t(spark, d, "events").select(F.concat(F.lit("chr"), (F.col("user_id") % 4).cast("string")).alias("chrom"), at.alias("start"), (at + 1 + F.col("user_id") % 40).alias("end"), F.col("event_id").alias("id"))


def with_views(sql: str) -> str:
    """DuckDB text with the views it names put in front."""
    ctes = {"reads": READS_SQL, "tags": TAGS_SQL, "matrix": MATRIX_SQL, "hits": HITS_SQL.replace("event_id div 4", "event_id // 4"), "intervals": INTERVALS_SQL, "event_intervals": EVENT_INTERVALS_SQL, "whitelist": f"select distinct {CB} as barcode from events"}
    import re

    used = [k for k in ctes if re.search(rf"\b{k}\b", sql) or (k == "tags" and re.search(r"\bmatrix\b", sql))]
    body = sql.strip()
    recursive = "recursive " if body.lower().startswith("with recursive") else ""
    if body.lower().startswith("with "):
        body = body[len("with recursive ") if recursive else len("with ") :]
        lead = ", "
    else:
        lead = " "
    head = ", ".join(f"{k} as ({ctes[k]})" for k in used)
    if not head:
        return duck(sql)
    return duck(f"with {recursive}{head}{lead}{body}")
