import pytest
from pyspark.sql import functions as F

from pairgrid.operators import audit, rings

RECORDS = "sample_id STRING, scene_name STRING, frame_index INT, camera_id STRING, assets ARRAY<STRING>, content_sha256 STRUCT<gt: STRING, input: STRING, target: STRING>"
JOBS = (
    "scene_name STRING, obj_id STRING, global_uid STRING, instance_token STRING, category STRING, "
    "exact_asset_binding STRUCT<global_uid: STRING, obj_id: STRING, instance_token: STRING, category: STRING>, "
    "target_usable_by_frame_camera MAP<STRING,BOOLEAN>"
)


def hashes(camera, edited=False, extra=""):
    return ("g" + camera + "0" * 62, ("e" if edited else "t") + camera + extra.ljust(62, "0"), "t" + camera + "0" * 62)


def record(sample, camera, asset=None, **kw):
    return (sample, "scene-0001", 12, camera, [asset] if asset else [], hashes(camera, bool(asset), **kw))


def base():
    rows = [record(f"baseline-c{c}", c) for c, _ in rings.RING]
    return rows + [record("selected-c0", "0", "asset-one"), record("selected-c2", "2", "token-one")]


def jobs_of(spark, **seen):
    usable = {f"000012:c{c}": c in "02" for c in "012345"} | {f"000012:c{k[1:]}": v for k, v in seen.items()}
    row = ("scene-0001", "obj-one", "asset-one", "token-one", "car", ("asset-one", "obj-one", "token-one", "car"), usable)
    return spark.createDataFrame([row], JOBS)


def grouped(spark, rows, jobs):
    return rings.candidate_groups(spark.createDataFrame(rows, RECORDS), jobs)


def findings(spark, groups, rows, jobs, files=None):
    records = rings.asset_signature(spark.createDataFrame(rows, RECORDS), rings.alias_table(jobs))
    stored = audit.ring_files(groups).select("name", F.col("expected").alias("sha256")) if files is None else files
    return audit.audit_rings(groups, records, rings.visibility(jobs), rings.asset_categories(jobs), stored)


def test_one_group_of_eighteen_images_with_two_edited_views(spark):
    jobs = jobs_of(spark)
    accepted, excluded = grouped(spark, base(), jobs)
    assert excluded.count() == 0
    groups = rings.ring_records(accepted).cache()
    row = groups.first()
    assert row.selected_asset_ids == ["asset-one"] and row.group_id.startswith("scene-0001__f012__g-")
    assert [v.camera_id for v in row.views] == [c for c, _ in rings.RING]
    for v in row.views:
        assert v.asset_visible == (v.camera_id in "02")
        assert (v.content_sha256.input == v.content_sha256.target) != v.asset_visible
    assert audit.ring_files(groups).select("name").distinct().count() == 18
    clean = findings(spark, groups, base(), jobs)
    summary = audit.ring_audit_summary(groups, clean).first()
    assert (summary.status, summary.all_images_checked, summary.checked_image_count) == ("pass", True, 18)


def test_altered_visibility_and_extra_files_fail_the_audit(spark):
    jobs = jobs_of(spark)
    groups = rings.ring_records(grouped(spark, base(), jobs)[0]).cache()
    changed = findings(spark, groups, base(), jobs_of(spark, c2=False)).collect()
    assert [r.errors for r in changed] == [["visibility_binding_mismatch"]]
    files = audit.ring_files(groups).select("name", F.col("expected").alias("sha256"))
    extra = files.unionByName(spark.createDataFrame([("unexpected.png", "x" * 64)], "name STRING, sha256 STRING"))
    assert [r.errors for r in findings(spark, groups, base(), jobs, extra).collect()] == [["flat_png_membership_mismatch"]]


@pytest.mark.parametrize(
    "rows, seen, reason",
    [
        (base()[:-1], {}, "visible camera 2 has no matching audited pair"),
        (base() + [record("other-c2", "2", "obj-one", extra="x")], {}, "visible camera 2 has conflicting audited inputs"),
        (base() + [record("other-c2", "2", "obj-one", extra="x")], {"c3": True}, "visible camera 2 has conflicting audited inputs"),
        (base(), {"c3": True}, "visible camera 3 has no matching audited pair"),
        (base(), {"c0": False, "c2": False}, "selected asset has no explicit visibility evidence"),
    ],
)
def test_exclusion_reasons(spark, rows, seen, reason):
    accepted, excluded = grouped(spark, rows, jobs_of(spark, **seen))
    assert accepted.count() == 0
    assert [r.reason for r in excluded.collect()] == [reason]


def test_an_ambiguous_background_makes_the_frame_incomplete(spark):
    odd = ("odd", "scene-0001", 12, "4", [], ("x" * 64, "t" * 64, "t4" + "0" * 62))
    df = spark.createDataFrame(base() + [odd], RECORDS)
    assert rings.complete_frames(df).count() == 0
    assert rings.complete_frames(spark.createDataFrame(base()[:-3], RECORDS)).count() == 0
    assert rings.complete_frames(spark.createDataFrame(base(), RECORDS)).count() == 1


def test_signatures(spark):
    aliases = spark.createDataFrame([("a", "one"), ("b", "one"), ("c", "two")], "alias STRING, asset_id STRING")
    rows = [("r1", ["c", "a"]), ("r2", ["a", "b"]), ("r3", ["a", "nobody"]), ("r4", ["a", ""]), ("r5", []), ("r6", None)]
    df = spark.createDataFrame(rows, "sample_id STRING, assets ARRAY<STRING>")
    got = {r.sample_id: r.signature for r in rings.asset_signature(df, aliases).collect()}
    assert got == {"r1": ["one", "two"], "r2": ["one", "one"], "r3": [], "r4": [], "r5": [], "r6": []}
    with pytest.raises(Exception, match="alias of several assets: a"):
        rings.asset_signature(df, aliases.unionAll(aliases.selectExpr("alias", "'other'").where("alias = 'a'"))).collect()


def test_an_empty_layer_list_hides_the_assets(spark):
    schema = "asset_layers ARRAY<STRUCT<obj_id: STRING>>, assets ARRAY<STRUCT<global_uid: STRING, obj_id: STRING, asset_id: STRING, instance_token: STRING>>"
    rows = [([], [("u", None, None, None)]), (None, [("", "o", None, None)]), ([("z",), ("y",), ("z",)], None)]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(rings.record_assets(F.col("asset_layers"), F.col("assets"))).collect()]
    assert got == [[], ["o"], ["y", "z"]]


def test_selectors_and_limit(spark):
    jobs = jobs_of(spark)
    df = spark.createDataFrame(base(), RECORDS)
    assert rings.ring_candidates(df, jobs, categories=["truck"]).count() == 0
    assert rings.ring_candidates(df, jobs, scenes=["scene-0002"]).count() == 0
    accepted = rings.accepted_groups(rings.ring_candidates(df, jobs, scenes=["scene-0001"], categories=["car"]))
    assert rings.top_groups(accepted, 1).first().visible_cameras == 2


def test_a_hot_frame_and_a_hot_asset_stay_whole(spark):
    # A third of all rows repeat one pair; the rest are frames of their own.
    hot = spark.range(3000).select(
        F.concat(F.lit("hot-"), F.col("id").cast("string")).alias("sample_id"), F.lit("scene-0001").alias("scene_name"),
        F.lit(12).alias("frame_index"), F.lit("0").alias("camera_id"), F.array(F.lit("asset-one")).alias("assets"),
        F.struct(*[F.lit(h).alias(n) for n, h in zip(("gt", "input", "target"), hashes("0", True))]).alias("content_sha256"),
    )
    jobs = jobs_of(spark)
    rows = spark.createDataFrame(base(), RECORDS).unionByName(hot)
    accepted, excluded = rings.candidate_groups(rows, jobs)
    row = rings.ring_records(accepted).first()
    assert row.views[0].source_pair_sample_id == "hot-0" and excluded.count() == 0


def test_visibility_manifest_checks(spark):
    jobs = jobs_of(spark)
    assert rings.visibility_violations(jobs).count() == 0
    wrong = jobs.withColumn("target_usable_by_frame_camera", F.create_map(F.lit("000012:c9"), F.lit(True)))
    assert [r.code for r in rings.visibility_violations(wrong).collect()] == ["unknown_camera"]
    other = jobs.withColumn("exact_asset_binding", F.col("exact_asset_binding").withField("global_uid", F.lit("asset-two")))
    assert {r.alias for r in rings.alias_conflicts(jobs.unionByName(other)).collect()} == {"obj-one", "token-one", "asset-one"}
