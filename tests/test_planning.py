import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pairgrid.operators import planning, review

ASSETS = "asset_id STRING, obj_id STRING, instance_token STRING, category STRING, ply_path STRING, ply_sha256 STRING, dimensions_m ARRAY<DOUBLE>, forward_axis STRING"
OBS = "scene_name STRING, window_id STRING, frame_index INT, obj_id STRING, instance_token STRING, area_pixels LONG, visibility_level INT, visible_cameras ARRAY<STRING>, review_images MAP<STRING,STRING>"


def two_assets(spark):
    return spark.createDataFrame(
        [
            (f"asset-000{i}", f"obj-{i}", f"token-{i}", "car", f"p{i}.ply", str(i) * 64, [4.0 + i, 1.8, 1.6], "+X")
            for i in (1, 2)
        ],
        ASSETS,
    )


def two_observations(spark, **change):
    rows = [
        ("scene-0001", "w000010", 12, "obj-1", "token-1", 300, 4, ["c3", "0"], {"reference": "a.png"}),
        ("scene-0001", "w000010", 12, "obj-2", "token-2", 250, 4, ["c3"], {"reference": "b.png"}),
    ]
    df = spark.createDataFrame(rows, OBS)
    for name, value in change.items():
        df = df.withColumn(name, value)
    return df


def members(spark, rows):
    return planning.variants(
        spark.createDataFrame([("s", "w000001", i, o) for i, o in rows], "scene_name STRING, window_id STRING, instance_token STRING, obj_id STRING")
    )


def test_capped_selections_keep_singles_and_never_mix_variants(spark):
    variants = members(spark, [("a", "a1"), ("a", "a2"), ("b", "b1"), ("c", "c1")])
    picked = [tuple(r.selected) for r in planning.window_selections(variants, 6, 20260818).collect()]
    assert len(picked) == 6
    assert {("a1",), ("a2",), ("b1",), ("c1",)} <= set(picked)
    assert not any({"a1", "a2"} <= set(p) for p in picked)
    every = {tuple(r.selected) for r in planning.window_selections(variants, 0, 1).collect()}
    assert len(every) == 3 * 2 * 2 - 1
    rest = sorted(
        (p for p in every if len(p) > 1),
        key=lambda p: hashlib.sha256(
            json.dumps({"seed": 20260818, "window": "s:w000001", "selected_obj_ids": p}, sort_keys=True, separators=(",", ":")).encode()
        ).hexdigest(),
    )
    assert {p for p in picked if len(p) > 1} == set(rest[:2])


def test_a_cap_below_the_singles_keeps_all_singles(spark):
    variants = members(spark, [("a", "a1"), ("b", "b1"), ("c", "c1")])
    assert planning.window_selections(variants, 2, 1).count() == 3


def test_enumeration_over_several_steps_is_whole(spark):
    # 14 instances of one or two variants: more than one unfolding step.
    variants = members(spark, [(f"i{k:02d}", f"o{k:02d}{v}") for k in range(14) for v in range(1 + k % 2)])
    got = planning.enumerate_combinations(variants)
    assert got.count() == 2**7 * 3**7 - 1
    assert got.select(F.concat_ws(",", "selected").alias("s")).distinct().count() == 2**7 * 3**7 - 1


def test_a_window_beyond_the_bound_fails_by_name(spark):
    variants = members(spark, [(f"i{k}", f"o{k}") for k in range(10)])
    with pytest.raises(Exception, match="too many combinations in s:w000001"):
        planning.enumerate_combinations(variants, 512).count()


def test_a_large_window_is_unfolded_on_several_tasks(spark):
    df = members(spark, [(f"i{k:02}", f"o{k:02}") for k in range(14)])
    found = planning.enumerate_combinations(df)
    assert found.count() == found.distinct().count() == 2**14 - 1
    assert found.select(F.spark_partition_id()).distinct().count() > 1


def test_a_window_that_cannot_be_numbered_fails_by_name(spark):
    variants = members(spark, [(f"i{k}", f"o{k}") for k in range(63)])
    with pytest.raises(Exception, match="too many combinations in s:w000001"):
        planning.enumerate_combinations(variants).count()


def test_projection_needs_every_object_of_a_selection(spark):
    # 130 objects in the window take three longs of a mask.
    names = [f"o{k:03}" for k in range(130)]
    shown = {("0", 0): names, ("0", 1): names[:-1], ("1", 0): names[60:70], ("1", 1): [names[0], names[129]]}
    rows = [("s", "w", f, c, o, [{"asset_id": o}], {"source": o}) for (c, f), objects in shown.items() for o in objects]
    jobs = spark.createDataFrame(
        rows, "scene_name STRING, window_id STRING, frame_index INT, camera_id STRING, obj_id STRING,"
        "assets ARRAY<STRUCT<asset_id: STRING>>, review_images MAP<STRING, STRING>"
    )
    picks = [names, names[62:64], [names[0], names[129]], [names[61], "elsewhere"], [names[69], names[70]]]
    wanted = spark.createDataFrame([("s", "w", p) for p in picks] + [("s", "other", names[:2])], "scene_name STRING, window_id STRING, selected ARRAY<STRING>")
    found = planning.project_combinations(wanted, jobs).collect()
    got = sorted((r.camera_id, r.frame_index, r.selected) for r in found)
    assert got == sorted((c, f, p) for (c, f), objects in shown.items() for p in picks if set(p) <= set(objects))
    assert all(sorted(m.review_images["source"] for m in r.members) == r.selected for r in found)


def test_strict_plan_refuses_repeated_bindings(spark):
    twice = two_assets(spark).unionByName(two_assets(spark).limit(1))
    with pytest.raises(ValueError, match="several assets"):
        planning.build_plan(two_observations(spark), twice)


def test_plan_counts_cameras_and_combinations(spark):
    jobs = planning.build_plan(two_observations(spark), two_assets(spark)).cache()
    summary = planning.plan_summary(jobs).first()
    assert (summary.job_count, summary.combination_job_count, summary.asset_count) == (4, 1, 2)
    assert summary.camera_counts == {"0": 1, "3": 3}
    combined = jobs.filter(F.size("assets") == 2).first()
    part = hashlib.sha256(b'["asset-0001","asset-0002"]').hexdigest()[:12]
    assert combined.sample_id == f"scene-0001__w000010__cmb-{part}__f012_c3"
    assert combined.review_images == {"asset_0_reference": "a.png", "asset_1_reference": "b.png"}
    rows, bad = review.asset_review_rows(jobs)
    assert rows.count() == 2 and bad.count() == 0
    verdicts = spark.createDataFrame([("asset-0001", False), ("asset-0002", True)], "sample_id STRING, hard_failure BOOLEAN")
    assert review.accepted_jobs(jobs, verdicts).count() == 2
    assert review.accepted_jobs(jobs, verdicts.filter("sample_id = 'asset-0001'")).count() == 2


def test_strict_plan_refuses_bad_tokens_cameras_and_repeats(spark):
    with pytest.raises(ValueError, match="instance token"):
        planning.build_plan(two_observations(spark, instance_token=F.lit("x")), two_assets(spark))
    with pytest.raises(ValueError, match="unknown camera"):
        planning.build_plan(two_observations(spark, visible_cameras=F.array(F.lit("9"))), two_assets(spark))
    twice = two_observations(spark).unionByName(two_observations(spark))
    with pytest.raises(ValueError, match="duplicate observation"):
        planning.build_plan(twice, two_assets(spark))


def test_capacity_rows_give_jobs_with_official_dimensions(spark):
    candidate = {
        "obj_id": "obj-1", "instance_token": "token-1", "official_size_wlh_m": [1.8, 4.2, 1.6],
        "projected_area_native_pixels": 300, "visibility_token": 4, "visible_target_frame_camera_keys": ["000013:c0", "000017:c3"],
    }
    schema = "scene_name STRING, context_start INT, context_frames ARRAY<INT>, target_frames ARRAY<INT>, candidates ARRAY<STRUCT<obj_id: STRING, instance_token: STRING, official_size_wlh_m: ARRAY<DOUBLE>, projected_area_native_pixels: LONG, visibility_token: INT, visible_target_frame_camera_keys: ARRAY<STRING>>>"
    windows = spark.createDataFrame([("scene-0001", 10, [10, 15, 20, 25], [13, 17], [candidate])], schema)
    assert planning.window_violations(windows).count() == 0
    flat = planning.flatten_capacity(windows).withColumn("review_images", F.create_map(F.lit("source"), F.lit("x.png")))
    jobs = planning.build_plan(flat, two_assets(spark)).collect()
    assert {j.camera_id for j in jobs} == {"0", "3"}
    assert all(j.assets[0].official_dimensions_m == [4.2, 1.8, 1.6] for j in jobs)
    broken = windows.withColumn("context_frames", F.array(F.lit(15), F.lit(10)))
    assert planning.window_violations(broken).first().codes == ["invalid_context_frames", "context_start_mismatch"]


def test_an_empty_camera_list_wins_over_the_map(spark):
    df = spark.createDataFrame(
        [([], {"c1": True}), (None, {"c1": True, "2": False}), (["c3", "3", "0"], None)], "l ARRAY<STRING>, m MAP<STRING,BOOLEAN>"
    )
    got = [r[0] for r in df.select(planning.camera_list(F.col("l"), F.col("m"))).collect()]
    assert got == [[], ["1"], ["0", "3"]]


def test_exclusions_must_be_known(spark):
    wanted = spark.createDataFrame([("obj-1",), ("",), ("nobody",)], "excluded_id STRING")
    kept, unknown = planning.exclude_assets(two_assets(spark), wanted)
    assert [r.obj_id for r in kept.collect()] == ["obj-2"]
    assert {r.excluded_id for r in unknown.collect()} == {"", "nobody"}
