"""Steps of the ring candidates: what is derived how often, and the frames they keep."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF

from __spark_entry__ import queries
from pairgrid.operators import rings
from pairgrid.plans import fixtures as fx


def test_baselines_take_no_reading_of_their_own(spark):
    plan = queries()["f13_ring_sources"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4 and "_answers" not in plan


def test_sets_of_complete_frames_have_their_donors(spark):
    n, frame = F.col("frame_index"), ["scene_name", "frame_index"]
    records = fx.records(spark, SF).withColumns(
        {
            "camera_id": F.when((n == 1) & (F.col("q") > 45), "9").when((n == 2) & (F.col("q") > 45), F.lit(None)).otherwise(F.col("camera_id")),
            "sample_id": F.when(n == 3, F.lit("same")).otherwise(F.col("sample_id")),
            "content_sha256": F.col("content_sha256").withField("target", F.when(n != 4, F.col("target"))),
        }
    )
    signed = records.withColumn("signature", F.when(F.col("q") < 5, F.array().cast("array<string>")).otherwise(F.col("selected"))).localCheckpoint()
    donors = rings.frame_baselines(records)
    expected = rings.candidate_sets(signed).join(donors, frame).select(*frame, "selected", "baselines")
    found = rings.complete_sets(signed).select(*frame, "selected", "baselines")
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(found) == rows(expected) and found.count() > 0
    frames = {r.frame_index for r in found.select("frame_index").distinct().collect()}
    assert 4 in frames
