"""Every query of the engine against DuckDB on the smallest data."""

from compare import compare

from cytoframe.plans import catalogue, files, more, runs  # noqa: F401  they register their queries too

DATA = "/root/testdata/sf0.001"


def test_queries_match_their_sql(spark):
    out = compare(spark, DATA, catalogue.QUERIES, catalogue.ORACLE)
    assert not {k: v for k, v in out.items() if not v.startswith(("ok", "rows"))}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
