"""Queries over rings of six cameras."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairgrid.operators import ring_release, rings
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.registry import query
from pairgrid.session import scratch_path
from pairgrid.sources import writers

_COMMA = ","

define("complete", ("records",), """
  SELECT scene_name, frame_index FROM (
    SELECT scene_name, frame_index, camera_id, count(DISTINCT gt || target) AS c FROM records GROUP BY ALL)
  GROUP BY ALL HAVING count(*) = 6 AND max(c) = 1""")

define("signed", ("records",), """
  SELECT *, list_sort(list_transform(selected, lambda s: 'uid-' || substr(s, 5))) AS sig FROM records""")

define("vis", ("obs",), """
  SELECT scene_name, frame_index, 'uid-' || substr(obj_id, 5) AS asset_id, camera_id FROM obs WHERE usable""")

define("exact", ("signed",), """
  SELECT scene_name, frame_index, camera_id, sig, min(sample_id) AS pair_id, count(DISTINCT input) AS inputs,
         min_by(input, sample_id) AS input
  FROM signed GROUP BY ALL""")

define("candidates", ("signed", "complete"), """
  SELECT DISTINCT s.scene_name, s.frame_index, s.sig FROM signed s JOIN complete c
    ON s.scene_name = c.scene_name AND s.frame_index = c.frame_index""")

define("ring", (), """
  SELECT * FROM (VALUES (0, '0', 'CAM_FRONT'), (1, '2', 'CAM_FRONT_RIGHT'), (2, '4', 'CAM_BACK_RIGHT'),
    (3, '5', 'CAM_BACK'), (4, '3', 'CAM_BACK_LEFT'), (5, '1', 'CAM_FRONT_LEFT')) t(pos, camera_id, camera_name)""")

define("baseline", ("records",), """
  SELECT scene_name, frame_index, camera_id, min(sample_id) AS baseline_id, min_by(gt, sample_id) AS gt,
         min_by(target, sample_id) AS target
  FROM records GROUP BY ALL""")

define("views", ("candidates", "ring", "vis"), """
  SELECT c.scene_name, c.frame_index, c.sig, r.pos, r.camera_id, r.camera_name,
         coalesce(list(v.asset_id ORDER BY v.asset_id) FILTER (v.asset_id IS NOT NULL), []) AS applied
  FROM (SELECT *, unnest(sig) AS asset_id FROM candidates) c CROSS JOIN ring r
  LEFT JOIN vis v ON v.scene_name = c.scene_name AND v.frame_index = c.frame_index
    AND v.asset_id = c.asset_id AND v.camera_id = r.camera_id
  GROUP BY ALL""")

define("unseen", ("candidates", "vis"), """
  SELECT DISTINCT c.scene_name, c.frame_index, c.sig
  FROM (SELECT *, unnest(sig) AS asset_id FROM candidates) c
  WHERE NOT EXISTS (SELECT 1 FROM vis v WHERE v.scene_name = c.scene_name AND v.frame_index = c.frame_index
                      AND v.asset_id = c.asset_id)""")

define("matched", ("views", "exact"), """
  SELECT v.*, e.pair_id, e.inputs, e.input,
         CASE WHEN len(v.applied) > 0 AND e.pair_id IS NULL
                THEN 'visible camera ' || v.camera_id || ' has no matching audited pair'
              WHEN e.inputs > 1 THEN 'visible camera ' || v.camera_id || ' has conflicting audited inputs' END AS failure
  FROM views v LEFT JOIN exact e ON e.scene_name = v.scene_name AND e.frame_index = v.frame_index
    AND e.camera_id = v.camera_id AND e.sig = v.applied""")

define("outcomes", ("matched", "unseen"), """
  SELECT m.scene_name, m.frame_index, m.sig, m.visible_cameras,
         coalesce(m.failure, CASE WHEN u.sig IS NOT NULL
           THEN 'selected asset has no explicit visibility evidence' END) AS reason,
         m.scene_name || '__' || printf('f%03d', m.frame_index) || '__g-'
           || substr(sha256(CAST(to_json(m.sig) AS VARCHAR)), 1, 12) AS group_id
  FROM (SELECT scene_name, frame_index, sig, min_by(failure, pos) FILTER (failure IS NOT NULL) AS failure,
               count_if(len(applied) > 0) AS visible_cameras FROM matched GROUP BY ALL) m
  LEFT JOIN unseen u ON u.scene_name = m.scene_name AND u.frame_index = m.frame_index AND u.sig = m.sig""")


def signed_records(spark, sf) -> DataFrame:
    return rings.asset_signature(fx.records(spark, sf), rings.alias_table(fx.visibility_jobs(spark, sf)), within=["scene_name"])


def _candidates(spark, sf, **kw) -> DataFrame:
    return rings.ring_candidates(fx.records(spark, sf), fx.visibility_jobs(spark, sf), **kw)


@query("a5_complete_frames", with_tables(("complete",), "SELECT * FROM complete"))
def _(spark, sf):
    return rings.complete_frames(fx.records(spark, sf))


@query("a6_pair_conflicts", with_tables(("exact",), """
  SELECT scene_name, frame_index, camera_id, array_to_string(sig, ',') AS signature FROM exact WHERE inputs > 1"""))
def _(spark, sf):
    return rings.pair_conflicts(signed_records(spark, sf)).withColumn("signature", F.concat_ws(_COMMA, "signature"))


def _loose_jobs(spark, sf):
    """Visibility jobs whose instance token is also given: two objects share one."""
    jobs = fx.visibility_jobs(spark, sf)
    number = F.substring("obj_id", 5, 20).cast("bigint")
    return jobs.withColumns(
        {
            "instance_token": F.format_string("inst-%06d", F.expr("cast(substring(obj_id, 5, 20) as bigint) div 2")),
            "category": F.when(F.col("scene_name") > "scene-00010", F.lit("van")).otherwise(fx.category(number)),
        }
    )


@query("a7_alias_conflicts", with_tables(("obs",), """
  SELECT instance_token AS alias, count(DISTINCT obj_id) AS asset_count FROM obs GROUP BY 1 HAVING count(DISTINCT obj_id) > 1"""))
def _(spark, sf):
    return rings.alias_conflicts(_loose_jobs(spark, sf))


@query("a7_category_conflicts", with_tables(("obs",), """
  SELECT 'inst-all-' || obj_no % 10 AS asset_id, count(DISTINCT obj_no % 4) AS category_count FROM obs GROUP BY 1
  HAVING count(DISTINCT obj_no % 4) > 1"""))
def _(spark, sf):
    # Jobs keyed by a coarse id, so that one asset meets several categories.
    n = F.substring("obj_id", 5, 20).cast("bigint")
    jobs = fx.visibility_jobs(spark, sf).withColumn(
        "exact_asset_binding",
        F.struct(
            F.concat(F.lit("inst-all-"), (n % 10).cast("string")).alias("global_uid"),
            "obj_id",
            F.lit(None).cast("string").alias("instance_token"),
            F.col("category"),
        ),
    )
    return rings.category_conflicts(jobs)


@query("a8_visibility", with_tables(("vis",), """
  SELECT scene_name, frame_index, asset_id, string_agg(camera_id, ',' ORDER BY camera_id) AS cameras
  FROM vis GROUP BY ALL"""))
def _(spark, sf):
    return rings.visibility(fx.visibility_jobs(spark, sf)).select(
        "scene_name", "frame_index", "asset_id", F.concat_ws(_COMMA, rings.cameras_in(F.col("camera_mask"))).alias("cameras")
    )


@query("u5_alias_union", with_tables(("obs",), """
  SELECT DISTINCT unnest([obj_id, 'uid-' || substr(obj_id, 5)]) AS alias, 'uid-' || substr(obj_id, 5) AS asset_id FROM obs"""))
def _(spark, sf):
    return rings.alias_table(fx.visibility_jobs(spark, sf))


@query("j7_asset_signature", with_tables(("signed",), "SELECT sample_id, array_to_string(sig, ',') AS signature FROM signed"))
def _(spark, sf):
    return signed_records(spark, sf).select("sample_id", F.concat_ws(_COMMA, "signature").alias("signature"))


@query("u2_candidate_sets", with_tables(("signed",), """
  SELECT DISTINCT scene_name, frame_index, array_to_string(sig, ',') AS selected FROM signed"""))
def _(spark, sf):
    return rings.candidate_sets(signed_records(spark, sf)).withColumn("selected", F.concat_ws(_COMMA, "selected"))


@query("l3_ordered_candidates", with_tables(("signed",), """
  SELECT DISTINCT scene_name, frame_index, array_to_string(sig, ',') AS selected FROM signed ORDER BY 1, 2, 3"""))
def _(spark, sf):
    return (
        rings.candidate_sets(signed_records(spark, sf))
        .orderBy("scene_name", "frame_index", "selected")
        .withColumn("selected", F.concat_ws(_COMMA, "selected"))
    )


def _eligible(spark, sf):
    complete = rings.complete_frames(fx.records(spark, sf))
    return rings.candidate_sets(signed_records(spark, sf)).join(complete, ["scene_name", "frame_index"], "left_semi")


@query("j11_eligible_candidates", with_tables(("candidates",), """
  SELECT scene_name, frame_index, array_to_string(sig, ',') AS selected FROM candidates"""))
def _(spark, sf):
    return _eligible(spark, sf).withColumn("selected", F.concat_ws(_COMMA, "selected"))


@query("j8_visible_by_camera", with_tables(("views",), """
  SELECT scene_name, frame_index, array_to_string(sig, ',') AS selected, camera_id,
         array_to_string(applied, ',') AS applied FROM views"""))
def _(spark, sf):
    ring = F.array(*[F.lit(c) for c, _ in rings.RING])
    return (
        rings.visible_by_camera(_eligible(spark, sf), rings.visibility(fx.visibility_jobs(spark, sf)))
        .select("scene_name", "frame_index", "selected", F.explode(F.arrays_zip(ring.alias("c"), F.col("visible"))).alias("v"))
        .select(
            "scene_name", "frame_index", F.concat_ws(_COMMA, "selected").alias("selected"),
            F.col("v.c").alias("camera_id"), F.concat_ws(_COMMA, "v.visible").alias("applied"),
        )
    )


@query("u7_visible_assets", with_tables(("views",), """
  SELECT scene_name, frame_index, array_to_string(sig, ',') AS selected, CAST(sum(len(applied)) AS BIGINT) AS visible_slots
  FROM views GROUP BY ALL"""))
def _(spark, sf):
    return rings.visible_by_camera(_eligible(spark, sf), rings.visibility(fx.visibility_jobs(spark, sf))).select(
        "scene_name", "frame_index", F.concat_ws(_COMMA, "selected").alias("selected"),
        F.size(F.flatten("visible")).cast("bigint").alias("visible_slots"),
    )


@query("a22_unseen_assets", with_tables(("unseen",), """
  SELECT scene_name, frame_index, array_to_string(sig, ',') AS selected FROM unseen"""))
def _(spark, sf):
    return (
        rings.visible_by_camera(_eligible(spark, sf), rings.visibility(fx.visibility_jobs(spark, sf)))
        .filter("unseen")
        .select("scene_name", "frame_index", F.concat_ws(_COMMA, "selected").alias("selected"))
    )


@query("w5_pick_source", with_tables(("exact",), """
  SELECT scene_name, frame_index, camera_id, array_to_string(sig, ',') AS signature, pair_id, input FROM exact"""))
def _(spark, sf):
    return rings.exact_pairs(signed_records(spark, sf)).select(
        "scene_name", "frame_index", "camera_id", F.concat_ws(_COMMA, "signature").alias("signature"),
        F.col("pair.sample_id").alias("pair_id"), F.col("pair.input").alias("input"),
    )


def _opened(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        "scene_name", "frame_index", F.concat_ws(_COMMA, "selected").alias("selected"), F.explode("views").alias("v")
    )


@query("j9_match_pairs", with_tables(("matched",), """
  SELECT scene_name, frame_index, array_to_string(sig, ',') AS selected, camera_id, pair_id FROM matched"""))
def _(spark, sf):
    return _opened(_candidates(spark, sf)).select(
        "scene_name", "frame_index", "selected", "v.camera_id", F.col("v.pair.sample_id").alias("pair_id")
    )


@query("j10_baselines", with_tables(("baseline", "complete"), """
  SELECT b.* FROM baseline b JOIN complete c ON b.scene_name = c.scene_name AND b.frame_index = c.frame_index"""))
def _(spark, sf):
    ring = F.array(*[F.lit(c) for c, _ in rings.RING])
    return (
        rings.frame_baselines(fx.records(spark, sf))
        .select("scene_name", "frame_index", F.explode(F.arrays_zip(ring.alias("c"), F.col("baselines"))).alias("b"))
        .select(
            "scene_name", "frame_index", F.col("b.c").alias("camera_id"),
            F.col("b.baselines.sample_id").alias("baseline_id"), "b.baselines.gt", "b.baselines.target",
        )
    )


@query("g3_candidate_groups", with_tables(("outcomes",), """
  SELECT group_id, scene_name, frame_index, array_to_string(sig, ',') AS selected,
         CAST(visible_cameras AS BIGINT) AS visible_cameras FROM outcomes WHERE reason IS NULL"""))
def _(spark, sf):
    return rings.accepted_groups(_candidates(spark, sf)).select(
        "group_id", "scene_name", "frame_index", F.concat_ws(_COMMA, "selected").alias("selected"),
        F.col("visible_cameras").cast("bigint").alias("visible_cameras"),
    )


@query("g3_excluded_reasons", with_tables(("outcomes",), """
  SELECT scene_name, frame_index, array_to_string(sig, ',') AS selected, reason FROM outcomes WHERE reason IS NOT NULL"""))
def _(spark, sf):
    return rings.excluded_groups(_candidates(spark, sf)).withColumn("selected", F.concat_ws(_COMMA, "selected"))


@query("w4_reason_counts", with_tables(("outcomes",), """
  SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM outcomes GROUP BY 1"""))
def _(spark, sf):
    return _candidates(spark, sf).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("p26_selected_groups", with_tables(("outcomes",), """
  SELECT group_id FROM outcomes WHERE reason IS NULL
    AND len(list_filter(sig, lambda s: CAST(substr(s, 5) AS BIGINT) % 4 > 1)) = 0"""))
def _(spark, sf):
    return rings.accepted_groups(_candidates(spark, sf, categories=("car", "truck"))).select("group_id")


define("ring_views", ("outcomes", "matched", "baseline"), """
  SELECT o.group_id, m.camera_id, m.camera_name, m.pair_id IS NOT NULL AS asset_visible,
         array_to_string(m.applied, ',') AS applied, m.pair_id AS source_pair, b.baseline_id AS source_baseline,
         b.gt AS gt_sha, coalesce(m.input, b.target) AS input_sha, b.target AS target_sha,
         o.group_id || '__' || m.camera_name || '__input.png' AS input_file
  FROM outcomes o JOIN matched m ON m.scene_name = o.scene_name AND m.frame_index = o.frame_index AND m.sig = o.sig
  JOIN baseline b ON b.scene_name = m.scene_name AND b.frame_index = m.frame_index AND b.camera_id = m.camera_id
  WHERE o.reason IS NULL""")


@query("g4_ring_records", with_tables(("ring_views",), "SELECT * FROM ring_views"))
def _(spark, sf):
    groups = rings.ring_records(rings.accepted_groups(_candidates(spark, sf)))
    return groups.select("group_id", F.explode("views").alias("v")).select(
        "group_id", "v.camera_id", "v.camera_name", "v.asset_visible",
        F.concat_ws(_COMMA, "v.applied_asset_ids").alias("applied"),
        F.col("v.source_pair_sample_id").alias("source_pair"), F.col("v.baseline_sample_id").alias("source_baseline"),
        F.col("v.content_sha256.gt").alias("gt_sha"), F.col("v.content_sha256.input").alias("input_sha"),
        F.col("v.content_sha256.target").alias("target_sha"), F.col("v.files.input").alias("input_file"),
    )


@query("f13_ring_sources", with_tables(("ring_views",), """
  SELECT group_id, camera_id, role, source_role, source_sample_id, sha256, file_name FROM (
    SELECT group_id, camera_id, unnest(['gt', 'input', 'target']) AS role,
           unnest(['gt', CASE WHEN asset_visible THEN 'input' ELSE 'target' END, 'target']) AS source_role,
           unnest([source_baseline, coalesce(source_pair, source_baseline), source_baseline]) AS source_sample_id,
           unnest([gt_sha, input_sha, target_sha]) AS sha256,
           unnest([replace(input_file, '__input.png', '__gt.png'), input_file,
                   replace(input_file, '__input.png', '__target.png')]) AS file_name
    FROM ring_views)"""))
def _(spark, sf):
    return rings.ring_sources(rings.accepted_groups(_candidates(spark, sf)))


@query("l1_top_groups", with_tables(("outcomes",), """
  SELECT group_id, CAST(visible_cameras AS BIGINT) AS visible_cameras FROM outcomes WHERE reason IS NULL
  ORDER BY outcomes.visible_cameras DESC, group_id LIMIT 100"""))
def _(spark, sf):
    return rings.top_groups(rings.accepted_groups(_candidates(spark, sf)), 100).select(
        "group_id", F.col("visible_cameras").cast("bigint").alias("visible_cameras")
    )


@query("a15_ring_summary", with_tables(("outcomes", "complete"), """
  SELECT (SELECT count(*) FROM (SELECT DISTINCT scene_name, frame_index FROM records)) AS source_scene_frame_count,
         (SELECT count(*) FROM complete) AS complete_unambiguous_ring_frame_count,
         count(*) AS candidate_group_count, CAST(count_if(reason IS NULL) AS BIGINT) AS complete_group_count_before_limit,
         CAST(count_if(reason IS NOT NULL) AS BIGINT) AS excluded_group_count,
         CAST(count_if(reason IS NULL) AS BIGINT) AS group_count, CAST(count_if(reason IS NULL) * 18 AS BIGINT) AS image_count
  FROM outcomes"""))
def _(spark, sf):
    records = fx.records(spark, sf)
    return rings.ring_summary(records, rings.ring_candidates(records, fx.visibility_jobs(spark, sf)))


@query("g3_refusals", with_tables(("obs", "records"), """
  SELECT 'invalid_record' AS code, sample_id AS subject FROM records WHERE q = 50
  UNION SELECT 'no_category', 'uid-' || substr(obj_id, 5) FROM obs WHERE obj_no % 7 = 3 AND obj_no % 17 <> 4
  UNION SELECT 'incomplete_identity', 'uid-' || substr(obj_id, 5) FROM obs WHERE obj_no % 17 = 4
  UNION SELECT 'unknown_camera', 'uid-' || substr(obj_id, 5) FROM obs WHERE obj_no % 11 = 5
  UNION SELECT 'changed_category', 'uid-' || substr(obj_id, 5) FROM obs WHERE obj_no % 13 = 2
  UNION SELECT 'ambiguous_alias', instance_token FROM obs WHERE obj_no % 20 < 2 GROUP BY 2 HAVING count(DISTINCT obj_no) > 1"""))
def _(spark, sf):
    n = F.substring("obj_id", 5, 20).cast("bigint")
    nothing = F.lit(None).cast("string")
    category = F.when(n % 7 != 3, F.col("category"))
    odd = F.create_map(F.lit("000000:c7"), F.lit(True))
    seen = F.col("target_usable_by_frame_camera")
    jobs = fx.visibility_jobs(spark, sf).withColumns(
        {
            "category": category,
            "exact_asset_binding": F.col("exact_asset_binding").withField("category", category),
            "scene_name": F.when(n % 17 != 4, F.col("scene_name")),
            "instance_token": F.when(n % 20 < 2, F.format_string("inst-%06d", F.expr("cast(substring(obj_id, 5, 20) as bigint) div 2"))).otherwise(nothing),
            "target_usable_by_frame_camera": F.when(n % 11 == 5, F.map_concat(seen, odd)).otherwise(seen),
        }
    )
    other = jobs.filter(n % 13 == 2).withColumn("exact_asset_binding", F.col("exact_asset_binding").withField("category", F.lit("other")))
    records = fx.records(spark, sf).withColumn("camera_id", F.when(F.col("q") == 50, "9").otherwise(F.col("camera_id")))
    return rings.ring_refusals(records, jobs.unionByName(other))


def _stored(records: DataFrame) -> DataFrame:
    hashes = F.col("content_sha256")
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), hashes[r].alias("sha256")) for r in ("gt", "input", "target")]))
    return records.select("sample_id", each.alias("f")).select("sample_id", "f.*")


@query("g4_publish_rings", with_tables(("ring_views",), """
  SELECT group_id, camera_id, asset_visible, source_pair, source_baseline, input_sha, input_file FROM ring_views"""))
def _(spark, sf):
    records = fx.records(spark, sf)
    dest = scratch_path(spark, "rings")
    ring_release.publish_rings(records, fx.visibility_jobs(spark, sf), _stored(records), dest)
    return writers.read_published(spark, f"{dest}/groups").select("group_id", F.explode("views").alias("v")).select(
        "group_id", "v.camera_id", "v.asset_visible", F.col("v.source_pair_sample_id").alias("source_pair"),
        F.col("v.baseline_sample_id").alias("source_baseline"), F.col("v.content_sha256.input").alias("input_sha"),
        F.col("v.files.input").alias("input_file"),
    )
