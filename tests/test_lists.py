"""Lists of names, tables of places, and genes of interest with the places of their cells."""

from cytoframe.operators import summaries
from cytoframe.operators.matrix import Matrix
from cytoframe.sources import annotation


def test_lists_and_places(spark, tmp_path):
    (tmp_path / "genes.txt").write_text("G1\n\n G2 \r\nG1\nnone\n")
    (tmp_path / "places.tsv").write_text("a\t1\t2\r\nb\t3\t4\nc\tx\t5\nd\t7\n\n")
    names = annotation.read_names(spark, f"{tmp_path}/genes.txt")
    assert sorted(r.name for r in names.collect()) == ["G1", "G2", "none"]
    places = annotation.read_coordinates(spark, f"{tmp_path}/places.tsv")
    assert sorted((r.cell, r.x, r.y) for r in places.collect()) == [("a", 1, 2), ("b", 3, 4)]
    m = Matrix.from_values(spark.createDataFrame([("G1", "a", 2.0), ("G2", "c", 1.0), ("G3", "a", 9.0)], "feature string, cell string, value double"))
    got = sorted((r.gene, r.barcode, r["count"], r.x, r.y) for r in summaries.genes_of_interest(m, names, places).collect())
    assert got == [("G1", "a", 2.0, 1, 2), ("G2", "c", 1.0, None, None)]


def test_places_by_name(spark):
    m = Matrix.from_values(spark.createDataFrame([("G1", "s_002um_00012_00034-1", 2.0)], "feature string, cell string, value double"))
    one = summaries.genes_of_interest(m, spark.createDataFrame([("G1",)], "name string")).first()
    assert (one.x, one.y) == (12, 34)
