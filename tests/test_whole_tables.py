"""Queries over whole tables: no row stays out."""

import pytest

from cytoframe.plans import catalogue, views

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["umi_cluster", "umi_region_fallback"])
def test_every_read_is_clustered(spark, name):
    got = catalogue.QUERIES[name](spark, DATA)
    reads = views.reads(spark, DATA).selectExpr("string(user_id) as cb", "ur").distinct()
    assert reads.subtract(got.select("cb", "ur")).count() == 0
    assert got.where("int(cb) % 3 = 0").count() and got.where("int(cb) % 3 = 2").count()


def test_every_row_takes_part(spark):
    """All events are hits, all orders are fusions and intervals."""
    orders, events = (views.t(spark, DATA, x) for x in ("orders", "events"))
    assert views.hits(spark, DATA).count() == events.count() == views.event_intervals(spark, DATA).count()
    assert catalogue.QUERIES["fusion_explode"](spark, DATA).count() == 3 * orders.count()
    merged = catalogue.QUERIES["interval_slop_merge"](spark, DATA)
    i = views.intervals(spark, DATA).withColumnsRenamed({"start": "s", "end": "e"})
    assert i.join(merged, "chrom").where("start <= s and e <= end").select("id").distinct().count() == orders.count()
