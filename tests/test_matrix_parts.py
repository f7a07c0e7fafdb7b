"""Matrix queries: tags are dealt by their number, and what follows deals by it too or sorts no values."""

import re

import pytest

from cytoframe.operators import matrix, reduction
from cytoframe.operators.matrix import Matrix
from cytoframe.plans import catalogue, files, more, views  # noqa: F401  they register the queries

SF = "/root/testdata/sf0.001"
plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
rows = lambda df: sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["matrix_mito_pct", "matrix_normalize_log", "matrix_downsample"])
def test_queries_deal_by_rows(spark, monkeypatch, name):
    want = rows(catalogue.QUERIES[name](spark, SF))
    monkeypatch.setattr(matrix, "ROWS_A_TASK", 500)
    dealt = str(-(-views.tags(spark, SF).where("gene <> '-'").count() // 500))
    found = catalogue.QUERIES[name](spark, SF)
    numbers = re.findall(r"hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", plan(found))
    assert int(dealt) > 4 and len(numbers) == (3 if name == "matrix_normalize_log" else 2) and set(numbers) == {dealt}
    assert rows(found) == want


def test_normalised_matrix_for_components_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(matrix, "ROWS_A_TASK", 500)
    dealt = -(-views.tags(spark, SF).where("gene <> '-'").count() // 500)
    done = Matrix.from_tags(views.tags(spark, SF)).kept().normalize(10_000.0).log_transform()
    assert done.parts == dealt and re.search(rf"hashpartitioning\(cell#\d+, {dealt}\), REPARTITION_BY_NUM", plan(done.values))


@pytest.mark.parametrize("name", ["matrix_filter_cells_then_features", "matrix_filter_features_then_cells"])
def test_filters_sort_no_values(spark, name):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # as for long axes
    try:
        found = plan(catalogue.QUERIES[name](spark, SF))
    finally:
        spark.conf.set(limit, before)
    assert "ShuffledHashJoin" in found and "SortMergeJoin" not in found


def test_unknown_features_are_left_out_of_a_written_matrix(spark):
    found = more.matrix_remove_unknown(spark, SF)
    assert found.inputFiles() and all("/matrix-" in f for f in found.inputFiles())


def test_products_with_long_weights_sort_no_values(spark, monkeypatch):
    values = spark.createDataFrame([("g1", "c1", 2.0), ("g2", "c1", 3.0), ("g1", "c2", 5.0)], "feature string, cell string, value double")
    weights = spark.createDataFrame([("c1", [1.0, 10.0]), ("c2", [2.0, 0.0])], "cell string, w array<double>")
    want = [("g1", [12.0, 20.0]), ("g2", [3.0, 30.0])]
    assert rows(reduction._product(values, "feature", "cell", weights, 2)) == want
    monkeypatch.setattr(reduction, "SENT", 0, raising=False)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        found = reduction._product(values, "feature", "cell", weights, 2)
        assert "ShuffledHashJoin" in plan(found) and "SortMergeJoin" not in plan(found)
        assert rows(found) == want
    finally:
        spark.conf.set(limit, before)
