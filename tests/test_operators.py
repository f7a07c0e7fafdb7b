"""Small cases of the operators."""

import pytest

from cytoframe.operators import adapters, barcodes, features
from cytoframe.operators.matrix import Matrix


@pytest.mark.parametrize("blocked", [True, False])
def test_barcode_reasons(spark, blocked):
    """One barcode of each kind: listed, one edit from an entry, between two entries, near none, and too short to be looked at."""
    listed = ["ACGTTGCAACGTTGCA", "GGATCCTTAGGCATCA", "GGATCCTTAGGCATTT"]
    wl = spark.createDataFrame([(x,) for x in listed], "barcode string")
    want = {
        "ACGTTGCAACGTTGCA": ("ACGTTGCAACGTTGCA", "bc_shortlist_exact_match"),
        "ACGTTGCAACGTTGCC": ("ACGTTGCAACGTTGCA", "bc_corrected"),
        "GGATCCTTAGGCATCT": (None, "bc_shortlist_multiple_hits"),
        "TTTTTTTTTTTTTTTT": (None, "bc_no_shortlist_match"),
        "ACGTTGCAACGT": (None, None),
    }
    got = barcodes.correct(spark.createDataFrame([(r,) for r in want], "cr string"), wl, blocked=blocked, barcode_length=16).collect()
    assert {r.cr: (r.cb, r.reason) for r in got} == want


def test_feature_assignment(spark):
    """One alignment; two of which the better covers enough; two of which neither does; a gene that maps badly."""
    aln = spark.createDataFrame([("one", "t1", 90, 0.3, 0.9, 50), ("best", "t1", 60, 0.3, 0.7, 0), ("best", "t2", 80, 0.6, 0.9, 40), ("thin", "t1", 60, 0.1, 0.2, 0), ("thin", "t2", 80, 0.1, 0.3, 40), ("far", "t2", 70, 0.5, 0.5, 9)], "read_id string, query_transcript string, aln_score int, tr_cov double, q_cov double, tr_mapq int")
    tmap = spark.createDataFrame([("t1", "ref1", "="), ("t2", "ref2", "=")], "qry_id string, ref_id string, class_code string")
    gtf = spark.createDataFrame([("ref1", "g1"), ("ref2", "g2")], "ref_id string, gene_name string")
    genome = spark.createDataFrame([("one", 30), ("best", 60), ("thin", 60), ("far", 29)], "read_id string, mapq int")
    got = {r.read_id: (r.gene, r.transcript) for r in features.assign_features(aln, tmap, gtf, genome).collect()}
    assert got == {"one": ("g1", "ref1"), "best": ("g2", "ref2"), "thin": ("g2", "-"), "far": ("-", "ref2")}


def test_matrix_masks_and_normalising(spark):
    m = Matrix.from_values(spark.createDataFrame([("f1", "c1", 1), ("f2", "c1", 1), ("f2", "c2", 1), ("f3", "c2", 1), ("f3", "c3", 1)], "feature string, cell string, value long"))
    axes = lambda x: ({r.feature for r in x.features.collect()}, {r.cell for r in x.cells.collect()})
    assert axes(m.remove_cells(2).remove_features(2)) == ({"f2"}, {"c1", "c2"})
    assert axes(m.remove_features(2).remove_cells(2)) == ({"f2", "f3"}, {"c2"})
    assert axes(m.remove_cells_and_features(2, 2)) == ({"f2", "f3"}, {"c1", "c2"})
    n = Matrix.from_values(spark.createDataFrame([("f1", "a", 10), ("f1", "b", 20), ("f2", "a", 30), ("f2", "b", 40)], "feature string, cell string, value long"))
    got = {(r.feature, r.cell): round(r.value, 8) for r in n.normalize(100.0).log_transform().values.collect()}
    assert got == {("f1", "a"): 1.41497335, ("f1", "b"): 1.53571597, ("f2", "a"): 1.88081359, ("f2", "b"): 1.83037478}
    z = Matrix(spark.createDataFrame([("f1", "b", 1), ("f1", "c", 2), ("f2", "b", 3)], "feature string, cell string, value long"), n.features, spark.createDataFrame([("a",), ("b",), ("c",)], "cell string"))
    assert {r.cell: r.mean_expression for r in z.mean_expression().collect()} == {"a": 0, "b": 2, "c": 1}
    assert tuple(z.medians().first()) == (2, 1, 3)


@pytest.mark.parametrize(("targets", "want"), [(["*"], [("*", "no_adapters", "*")]), (["adapter1_f"], [("adapter1_f", "single_adapter1", "+")]), (["adapter2_r"], [("adapter2_r", "single_adapter2", "-")]), (["adapter2_r", "adapter1_f"], [("adapter2_r-adapter1_f", "other", "*")]), (["adapter1_r", "adapter1_f"], [("adapter1_r-adapter1_f", "double_adapter1", "*")]), (["adapter2_f", "adapter2_r"], [("adapter2_f-adapter2_r", "double_adapter2", "*")]), (["adapter1_f", "adapter2_f", "adapter2_r", "adapter1_r"], [("adapter1_f-adapter2_f", "full_len", "+"), ("adapter2_r-adapter1_r", "full_len", "-")])])
def test_adapter_configurations(spark, targets, want):
    hits = spark.createDataFrame([("r", x, 1 + 100 * i, 20 + 100 * i, 500) for i, x in enumerate(targets)], "query string, target string, qilo long, qihi long, ql long")
    got = sorted((r.read_id, r.adapter_config, r.lab, r.strand) for r in adapters.subreads(hits).collect())
    assert [g[1:] for g in got] == want


def test_partition_count_does_not_matter(spark):
    from cytoframe.plans import catalogue

    seen = set()
    for n in ("1", "4", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.add(tuple(sorted(map(tuple, catalogue.QUERIES["umi_cluster"](spark, "/root/testdata/sf0.001").collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1
