"""The core pipeline deals its tables to more parts where rows are many, whatever spark.sql.shuffle.partitions is."""

import re

import pytest
from pyspark.sql import functions as F

from cytoframe.operators import barcodes
from cytoframe.plans import more, pipeline
from cytoframe.sources import scratch


def test_setting_comes_back(spark):
    before = spark.conf.get(scratch.PARTS)
    with pytest.raises(KeyError), scratch.dealt_by_rows(spark, 10 * scratch.ROWS_A_TASK + 1):
        assert spark.conf.get(scratch.PARTS) == "11"
        raise KeyError
    assert spark.conf.get(scratch.PARTS) == before
    with scratch.dealt_by_rows(spark, 5):
        assert spark.conf.get(scratch.PARTS) == before


def test_pipeline_tables_follow_the_rows(spark, monkeypatch):
    seen = {}
    counted = lambda s, rows, a_task=0: seen.setdefault("rows", rows) and 13
    record = lambda df, name: (seen.setdefault(name, df.sparkSession.conf.get(scratch.PARTS)), scratch.written(df, name))[1]
    monkeypatch.setattr(scratch, "parts_for", counted)
    for module in (more, pipeline):
        monkeypatch.setattr(module, "written", record)
    found = more.pipeline_processed_matrix(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and seen["rows"] == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert {k: v for k, v in seen.items() if k not in ("rows", "reads")} == {"tags": "13", "known": "13", "expression": "13"}


def test_variants_follow_the_strings(spark, monkeypatch):
    monkeypatch.setattr(barcodes, "STRINGS_A_TASK", 10)
    own = spark.range(200).select(F.expr("translate(substr(md5(cast(id as string)), 1, 7), '0123456789abcdef', 'ACGTACGTACGTACGT')").alias("cr")).distinct()
    listed = own.withColumnRenamed("cr", "wl")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    many = barcodes.within(own, listed, 2, 400)
    dealt = re.findall(r"hashpartitioning\(_k#\w+, (\d+)\), REPARTITION_BY_NUM", many._jdf.queryExecution().executedPlan().toString())
    assert dealt == ["40", "40"]
    assert rows(many) == rows(barcodes.within(own, listed, 2)) and len(rows(many)) > own.count()
