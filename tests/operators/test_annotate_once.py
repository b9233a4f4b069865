"""Cells of whole pairs are made once for all their annotations."""

from lawtrace.plans import annotation_queries, views


def test_cells_are_kept_and_clips_found_without_them(spark):
    folder = "/root/testdata/sf0.001"
    rows, _ = annotation_queries.annotated(spark, folder)
    plan = rows._jdf.queryExecution().withCachedData().toString().split("\n")
    assert any("InMemoryRelation" in x and "body_v" in x and "off" in x for x in plan)
    want = {r.clip_uid for r in views.cells(spark, folder).select("clip_uid").distinct().collect()}
    assert {r.clip_uid for r in views.cell_clips(spark, folder).collect()} == want
