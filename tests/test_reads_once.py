"""The core pipeline computes the view of its reads once and goes on from the written table."""

from cytoframe.plans import more


def test_features_come_from_written_reads(spark):
    tags, features = more._tags(spark, "/root/testdata/sf0.001")
    assert all("/reads-" in f for f in features.inputFiles())
    assert tags.count() == features.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
