"""Queries over planning: assets, observations, combinations and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairgrid.functions.semantics import key_violations
from pairgrid.operators import planning
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.registry import query
from pairgrid.session import staged

SEED = 20260818


# Asset rows of both manifest shapes: the older one nests hash and axis.
def _raw_assets(spark, sf):
    a = fx.assets(spark, sf)
    n = F.col("obj_no")
    old = n % 2 == 0
    return a.select(
        F.when(~old, F.col("asset_id")).otherwise("").alias("asset_id"),
        F.when(old, F.col("asset_id")).alias("global_uid"),
        F.when(n % 17 != 0, F.col("obj_id")).alias("obj_id"),
        "instance_token",
        "category",
        F.when(~old, F.col("ply_path")).alias("ply_path"),
        F.when(old, F.concat(F.lit("/abs/"), "ply_path")).alias("asset_path"),
        F.when(~old, F.col("ply_sha256")).alias("ply_sha256"),
        F.when(~old, F.when(n % 19 == 0, F.array(F.lit(1.0))).otherwise(F.col("dimensions_m")))
        .otherwise(F.array().cast("array<double>"))
        .alias("dimensions_m"),
        F.when(old, F.when(n % 23 == 0, F.array(F.lit(1.0), F.lit(0.0), F.lit(2.0))).otherwise(F.col("dimensions_m"))).alias("size_xyz"),
        F.when(~old, F.lit("+X")).alias("forward_axis"),
        F.struct(
            F.when(old, F.when(n % 29 == 0, F.lit("short")).otherwise(F.col("ply_sha256"))).alias("canonical_asset_sha256"),
            F.when(old, F.when(n % 31 == 0, F.lit("-X")).otherwise("+X")).alias("front_axis"),
        ).alias("canonical"),
    )


define("raw_assets", ("assets",), """
  SELECT asset_id, CASE WHEN obj_no % 17 <> 0 THEN obj_id ELSE '' END AS obj_id, instance_token, category,
         CASE WHEN obj_no % 2 = 0 THEN '/abs/' || ply_path ELSE 'root/' || ply_path END AS ply_path,
         CASE WHEN obj_no % 2 = 0 AND obj_no % 29 = 0 THEN 'short' ELSE ply_sha256 END AS ply_sha256,
         CASE WHEN obj_no % 2 = 0 AND obj_no % 31 = 0 THEN '-X' ELSE '+X' END AS forward_axis,
         CASE WHEN obj_no % 2 = 1 AND obj_no % 19 = 0 THEN 1 ELSE 3 END AS dims,
         (obj_no % 2 = 1 AND obj_no % 19 = 0) OR (obj_no % 2 = 0 AND obj_no % 23 = 0) AS bad_dims, obj_no FROM assets""")


@query("p1_normalize_assets", with_tables(("raw_assets",), """
  SELECT asset_id, obj_id, instance_token, category, ply_path, ply_sha256, forward_axis, CAST(dims AS BIGINT) AS dims
  FROM raw_assets"""))
def _(spark, sf):
    return planning.normalize_assets(_raw_assets(spark, sf), "root").select(
        "asset_id", "obj_id", "instance_token", "category", "ply_path", "ply_sha256", "forward_axis",
        F.size("dimensions_m").cast("bigint").alias("dims"),
    )


@query("p2_asset_violations", with_tables(("raw_assets",), """
  SELECT * FROM (SELECT asset_id, obj_id, array_to_string(list_filter([
    CASE WHEN obj_id = '' THEN 'incomplete_identity' END, CASE WHEN bad_dims THEN 'invalid_dimensions' END,
    CASE WHEN forward_axis <> '+X' THEN 'wrong_forward_axis' END,
    CASE WHEN ply_sha256 = 'short' THEN 'invalid_asset_hash' END], lambda c: c IS NOT NULL), ',') AS codes FROM raw_assets)
  WHERE codes <> ''"""))
def _(spark, sf):
    bad = planning.asset_violations(planning.normalize_assets(_raw_assets(spark, sf)))
    return bad.withColumn("codes", F.concat_ws(",", "codes"))


def _exclusions(spark, sf):
    """Objects whose review failed hard, by object id."""
    return fx.decisions(spark, sf).filter(F.col("decision.decision") != "accept").select(
        F.format_string("obj-%06d", "obj_no").alias("excluded_id")
    )


@query("p3_exclude_assets", with_tables(("assets", "decisions"), """
  SELECT asset_id, obj_id FROM assets WHERE obj_no NOT IN (SELECT obj_no FROM decisions WHERE decision <> 'accept')"""))
def _(spark, sf):
    kept, _ = planning.exclude_assets(fx.assets(spark, sf), _exclusions(spark, sf))
    return kept.select("asset_id", "obj_id")


@query("u4_unknown_exclusions", with_tables(("assets", "decisions"), """
  SELECT printf('obj-%06d', obj_no) AS excluded_id FROM decisions WHERE decision <> 'accept'
    AND obj_no NOT IN (SELECT obj_no FROM assets)"""))
def _(spark, sf):
    _, unknown = planning.exclude_assets(fx.assets(spark, sf), _exclusions(spark, sf))
    return unknown


@query("j14_verify_assets", with_tables(("assets",), """
  SELECT asset_id, ply_path AS path, CASE WHEN least = 2 THEN 'missing_file' ELSE 'hash_mismatch' END AS code
  FROM assets WHERE least = 2 OR obj_no % 5 = 0"""))
def _(spark, sf):
    a = fx.assets(spark, sf)
    n = F.col("obj_no")
    stored = a.filter(F.col("least") != 2).select(
        F.col("ply_path").alias("path"),
        F.when(n % 5 == 0, F.sha2("ply_path", 256)).otherwise(F.col("ply_sha256")).alias("sha256"),
    )
    return planning.verify_assets(a, stored)


# Capacity rows: one per window with nested candidates, some with explicit view keys.
def _capacity(spark, sf):
    per_object = (
        fx.obs(spark, sf)
        .groupBy("scene_name", "window_id", "obj_id", "instance_token")
        .agg(
            F.sort_array(F.collect_list(F.format_string("%06d:c%s", "frame_index", "camera_id"))).alias("keys"),
            F.min("frame_index").alias("first_frame"),
            F.max("area_pixels").alias("area"),
            F.max("visibility_level").alias("level"),
        )
    )
    candidate = F.struct(
        "obj_id",
        "instance_token",
        F.array(F.lit(1.8), F.lit(4.2), F.lit(1.6)).alias("official_size_wlh_m"),
        F.col("area").alias("projected_area_native_pixels"),
        F.col("level").alias("visibility_token"),
        F.when(F.size("keys") > 3, F.col("keys")).alias("visible_target_frame_camera_keys"),
        F.col("first_frame").alias("target_frame"),
        F.lit("0").alias("camera_id"),
    )
    start = F.substring("window_id", 2, 20).cast("int")
    return (
        per_object.groupBy("scene_name", "window_id")
        .agg(F.collect_list(candidate).alias("candidates"), F.min("area").alias("area"))
        .select(
            "scene_name",
            start.alias("context_start"),
            F.when(F.col("area") < 282, F.array(start, start)).otherwise(F.array(start, start + 1)).alias("context_frames"),
            F.when(F.col("area") > 252, F.array(start + 2)).alias("target_frames"),
            "candidates",
        )
    )


@query("p4_flatten_capacity", with_tables(("obs",), """
  SELECT scene_name, window_id, obj_id, key[1:6]::INT AS frame_index, key[9:] AS camera_id,
         CAST(area AS BIGINT) AS area_pixels, level AS visibility_level, 4.2::DOUBLE AS length
  FROM (SELECT scene_name, window_id, obj_id, max(area_pixels) AS area, max(visibility_level) AS level,
               unnest(CASE WHEN count(*) > 3 THEN list(printf('%06d:c%s', frame_index, camera_id))
                           ELSE [printf('%06d:c0', min(frame_index))] END) AS key
        FROM obs GROUP BY scene_name, window_id, obj_id)"""))
def _(spark, sf):
    return planning.flatten_capacity(_capacity(spark, sf)).select(
        "scene_name", "window_id", "obj_id", "frame_index", F.get("visible_cameras", F.lit(0)).alias("camera_id"),
        "area_pixels", "visibility_level", F.get("official_dimensions_m", F.lit(0)).alias("length"),
    )


@query("p5_window_violations", with_tables(("obs",), """
  SELECT scene_name, CAST(substr(window_id, 2) AS INT) AS context_start,
         CASE WHEN area <= 252 THEN 'invalid_context_frames,invalid_target_frames' ELSE 'invalid_context_frames' END AS codes
  FROM (SELECT scene_name, window_id, min(area) AS area FROM (
          SELECT scene_name, window_id, obj_id, max(area_pixels) AS area FROM obs GROUP BY ALL) GROUP BY ALL)
  WHERE area < 282"""))
def _(spark, sf):
    return planning.window_violations(_capacity(spark, sf)).withColumn("codes", F.concat_ws(",", "codes"))


@query("p6_camera_list", with_tables(("obs",), """
  SELECT scene_name, frame_index, obj_id,
         CASE WHEN max(q) > 45 THEN coalesce(string_agg(camera_id, ',' ORDER BY camera_id) FILTER (usable), '')
              ELSE string_agg(camera_id, ',' ORDER BY camera_id) END AS cameras FROM obs GROUP BY ALL"""))
def _(spark, sf):
    o = fx.obs(spark, sf).groupBy("scene_name", "frame_index", "obj_id").agg(
        F.collect_list(F.concat(F.lit("c"), "camera_id")).alias("listed"),
        F.map_from_entries(F.collect_list(F.struct("camera_id", "usable"))).alias("observed"),
        F.max("q").alias("q"),
    )
    listed = F.when(F.col("q") <= 45, F.col("listed"))
    return o.select(
        "scene_name", "frame_index", "obj_id", F.concat_ws(",", planning.camera_list(listed, F.col("observed"))).alias("cameras")
    )


@query("p7_eligible", with_tables(("observations",), """
  SELECT scene_name, frame_index, obj_id FROM observations WHERE area_pixels >= 30 AND visibility_level >= 2"""))
def _(spark, sf):
    return planning.eligible_observations(fx.observations(spark, sf)).select("scene_name", "frame_index", "obj_id")


define("bound", ("observations", "assets"), """
  SELECT o.*, a.asset_id, a.category, a.ply_sha256, a.least FROM observations o JOIN assets a ON o.obj_id = a.obj_id
  WHERE o.area_pixels >= 30 AND o.visibility_level >= 2""")


def _bound(spark, sf):
    return planning.bind_assets(planning.eligible_observations(fx.observations(spark, sf)), fx.assets(spark, sf))


@query("j1_bind_assets", with_tables(("observations", "assets"), """
  SELECT o.scene_name, o.frame_index, o.obj_id, a.asset_id,
         o.frame_index = 3 AND o.area_pixels > 270 AS token_differs
  FROM observations o JOIN assets a ON o.obj_id = a.obj_id"""))
def _(spark, sf):
    o = fx.observations(spark, sf).withColumn(
        "instance_token",
        F.when((F.col("frame_index") == 3) & (F.col("area_pixels") > 270), F.lit("inst-other")).otherwise(F.col("instance_token")),
    )
    return planning.bind_assets(o, fx.assets(spark, sf)).select("scene_name", "frame_index", "obj_id", "asset_id", "token_differs")


# Identity rows exist for most assets; some contradict the binding.
def _identity(spark, sf):
    a = fx.assets(spark, sf)
    n = F.col("obj_no")
    return a.filter(F.col("least") != 3).select(
        "obj_id",
        "instance_token",
        F.when(n % 25 == 0, F.lit("other")).otherwise(F.col("category")).alias("category"),
        F.when(n % 35 == 0, F.lit("")).otherwise(F.col("ply_sha256")).alias("canonical_asset_sha256"),
        F.concat(F.lit("sheets/"), "obj_id").alias("review_sheet"),
        F.sha2("obj_id", 256).alias("review_sheet_sha256"),
        F.when(n % 3 == 0, F.concat(F.lit("views/"), "obj_id")).alias("ply_evidence"),
        F.sha2(F.concat(F.lit("v"), "obj_id"), 256).alias("ply_evidence_sha256"),
    )


@query("j2_bind_identity", with_tables(("bound",), """
  SELECT scene_name, frame_index, obj_id, CASE WHEN least = 3 THEN 'missing_identity'
         WHEN obj_no % 25 = 0 OR obj_no % 35 = 0 THEN 'identity_differs' END AS identity_code FROM bound"""))
def _(spark, sf):
    return planning.bind_identity(_bound(spark, sf), _identity(spark, sf)).select(
        "scene_name", "frame_index", "obj_id", "identity_code"
    )


def _evidence(spark, sf):
    bound = planning.bind_identity(_bound(spark, sf), _identity(spark, sf))
    own = F.when(F.col("frame_index") == 0, F.col("review_images"))
    return planning.review_evidence(bound.withColumn("review_images", own))


define("evidence", ("bound",), """
  SELECT *, CASE WHEN frame_index = 0 THEN ['source'] WHEN least = 3 THEN []
    WHEN obj_no % 3 = 0 THEN ['canonical_views', 'identity_sheet'] ELSE ['identity_sheet'] END AS labels FROM bound""")


@query("p9_review_evidence", with_tables(("evidence",), """
  SELECT scene_name, frame_index, obj_id, array_to_string(labels, ',') AS labels FROM evidence"""))
def _(spark, sf):
    return _evidence(spark, sf).select(
        "scene_name", "frame_index", "obj_id", F.concat_ws(",", F.sort_array(F.map_keys("review_images"))).alias("labels")
    )


@query("p9_evidence_violations", with_tables(("evidence",), """
  SELECT DISTINCT obj_id, label, CASE WHEN label = 'source' THEN 'missing_file' ELSE 'hash_mismatch' END AS code
  FROM (SELECT obj_id, obj_no, unnest(labels) AS label FROM evidence)
  WHERE label = 'source' OR (label = 'canonical_views' AND obj_no % 2 = 0)"""))
def _(spark, sf):
    i = _identity(spark, sf)
    sheets = i.select(F.col("review_sheet").alias("path"), F.col("review_sheet_sha256").alias("sha256"))
    even = F.substring("obj_id", 5, 20).cast("bigint") % 2 == 0
    seen = i.filter(F.col("ply_evidence").isNotNull()).select(
        F.col("ply_evidence").alias("path"),
        F.when(even, F.sha2("ply_evidence", 256)).otherwise(F.col("ply_evidence_sha256")).alias("sha256"),
    )
    return planning.evidence_violations(_evidence(spark, sf), sheets.unionByName(seen))


define("jobs", ("bound",), """
  SELECT scene_name || '__' || window_id || '__' || asset_id || '__' || printf('f%03d', frame_index) || '_c' || camera_id AS sample_id,
         scene_name, window_id, frame_index, camera_id, obj_id, instance_token, asset_id, obj_no, area_pixels
  FROM (SELECT *, unnest(cameras) AS camera_id FROM bound)""")


def single_jobs(spark, sf):
    return planning.to_jobs(planning.review_evidence(_bound(spark, sf)))


@query("p8_jobs", with_tables(("jobs",), """
  SELECT sample_id, scene_name, window_id, frame_index, camera_id, obj_id, asset_id FROM jobs"""))
def _(spark, sf):
    return single_jobs(spark, sf).select(
        "sample_id", "scene_name", "window_id", "frame_index", "camera_id", "obj_id",
        F.get("assets", F.lit(0))["asset_id"].alias("asset_id"),
    )


@query("a1_key_violations", with_tables(("jobs",), """
  SELECT scene_name, asset_id, count(*) AS row_count FROM jobs GROUP BY ALL HAVING count(*) > 1"""))
def _(spark, sf):
    keyed = single_jobs(spark, sf).select("scene_name", F.get("assets", F.lit(0))["asset_id"].alias("asset_id"))
    return key_violations(keyed, ["scene_name", "asset_id"])


def _with_repeats(spark, sf):
    """Single jobs, with those of large objects listed twice under another binding."""
    jobs = single_jobs(spark, sf)
    again = jobs.filter(F.col("frame_index") == 0).withColumn("assets", F.array(F.get("assets", F.lit(0)).withField("forward_axis", F.lit("-X"))))
    return jobs.unionByName(again)


@query("a2_duplicate_observations", with_tables(("jobs",), """
  SELECT scene_name, window_id, frame_index, camera_id, obj_id, 2::BIGINT AS row_count FROM jobs WHERE frame_index = 0"""))
def _(spark, sf):
    return planning.duplicate_observations(_with_repeats(spark, sf))


@query("a3_window_conflicts", with_tables(("jobs",), """
  SELECT DISTINCT scene_name, window_id, obj_id, 2::BIGINT AS binding_count FROM jobs WHERE frame_index = 0"""))
def _(spark, sf):
    return planning.window_binding_conflicts(_with_repeats(spark, sf))


define("variants", ("jobs",), """
  SELECT scene_name, window_id, instance_token, list(DISTINCT obj_id ORDER BY obj_id) AS objects,
         row_number() OVER (PARTITION BY scene_name, window_id ORDER BY instance_token) AS rank
  FROM jobs GROUP BY scene_name, window_id, instance_token""")

define("members", ("jobs",), """
  SELECT scene_name, window_id, count(DISTINCT obj_id) AS member_count, count(DISTINCT instance_token) AS ranks
  FROM jobs GROUP BY ALL""")

define("folded", ("variants", "members"), """
  SELECT scene_name, window_id, 0::BIGINT AS rank, []::VARCHAR[] AS sel FROM members
  UNION ALL
  SELECT f.scene_name, f.window_id, v.rank, CASE WHEN p.o IS NULL THEN f.sel ELSE list_append(f.sel, p.o) END
  FROM folded f JOIN variants v ON v.scene_name = f.scene_name AND v.window_id = f.window_id AND v.rank = f.rank + 1,
       LATERAL (SELECT unnest(list_append(v.objects, NULL)) AS o) p""")

define("combos", ("folded", "members"), """
  SELECT f.scene_name, f.window_id, list_sort(f.sel) AS selected, m.member_count
  FROM folded f JOIN members m ON m.scene_name = f.scene_name AND m.window_id = f.window_id AND m.ranks = f.rank
  WHERE len(f.sel) > 0""")

define("capped", ("combos",), f"""
  SELECT scene_name, window_id, selected FROM (
    SELECT *, row_number() OVER (PARTITION BY scene_name, window_id, len(selected) > 1 ORDER BY
      sha256('{{"seed":{SEED},"selected_obj_ids":' || CAST(to_json(selected) AS VARCHAR) || ',"window":"' || scene_name
             || ':' || window_id || '"}}')) AS rank FROM combos)
  WHERE len(selected) = 1 OR rank <= greatest(0, 10 - member_count)""")


def _variants(spark, sf):
    jobs = single_jobs(spark, sf)
    return planning.variants(jobs.withColumn("instance_token", F.get("assets", F.lit(0))["instance_token"]))


@query("a4_variants", with_tables(("variants",), """
  SELECT scene_name, window_id, instance_token, array_to_string(objects, ',') AS objects FROM variants"""))
def _(spark, sf):
    return _variants(spark, sf).withColumn("objects", F.concat_ws(",", "objects"))


@query("g1_combinations", with_tables(("combos",), """
  SELECT scene_name, window_id, array_to_string(selected, ',') AS selected FROM combos""", recursive=True))
def _(spark, sf):
    return planning.enumerate_combinations(_variants(spark, sf)).select(
        "scene_name", "window_id", F.concat_ws(",", "selected").alias("selected")
    )


@query("w3_capped", with_tables(("capped",), """
  SELECT scene_name, window_id, array_to_string(selected, ',') AS selected FROM capped""", recursive=True))
def _(spark, sf):
    return planning.window_selections(_variants(spark, sf), 10, SEED).withColumn("selected", F.concat_ws(",", "selected"))


@query("l5_ordered_selections", with_tables(("combos",), """
  SELECT scene_name, window_id, array_to_string(selected, ',') AS selected FROM combos
  ORDER BY scene_name, window_id, len(combos.selected), combos.selected""", recursive=True))
def _(spark, sf):
    picked = planning.window_selections(_variants(spark, sf), 0, SEED)
    return planning.ordered_selections(picked).withColumn("selected", F.concat_ws(",", "selected"))


define("projected", ("capped", "jobs"), """
  SELECT j.scene_name, j.window_id, j.frame_index, j.camera_id, c.selected
  FROM capped c JOIN jobs j ON j.scene_name = c.scene_name AND j.window_id = c.window_id AND list_contains(c.selected, j.obj_id)
  WHERE len(c.selected) > 1
  GROUP BY ALL HAVING count(*) = len(c.selected)""")


@query("j3_projected", with_tables(("projected",), """
  SELECT scene_name, window_id, frame_index, camera_id, array_to_string(selected, ',') AS selected FROM projected""", recursive=True))
def _(spark, sf):
    jobs = staged(single_jobs(spark, sf), "jobs")
    members = jobs.withColumn("instance_token", F.get("assets", F.lit(0))["instance_token"])
    picked = planning.window_selections(planning.variants(members), 10, SEED).filter(F.size("selected") > 1)
    return planning.project_combinations(picked, jobs).select(
        "scene_name", "window_id", "frame_index", "camera_id", F.concat_ws(",", "selected").alias("selected")
    )


define("plan", ("projected", "jobs"), """
  SELECT sample_id, scene_name, camera_id, [asset_id] AS asset_ids FROM jobs
  UNION ALL
  SELECT scene_name || '__' || window_id || '__cmb-' || substr(sha256(CAST(to_json(
           list_transform(selected, lambda o: 'a' || lpad(substr(o, 5), 11, '0'))) AS VARCHAR)), 1, 12)
           || '__' || printf('f%03d', frame_index) || '_c' || camera_id,
         scene_name, camera_id, list_transform(selected, lambda o: 'a' || lpad(substr(o, 5), 11, '0')) FROM projected""")


def plan(spark, sf):
    return planning.build_plan(fx.observations(spark, sf), fx.assets(spark, sf), cap=10, seed=SEED)


@query("g2_plan", with_tables(("plan",), """
  SELECT sample_id, scene_name, camera_id, array_to_string(asset_ids, ',') AS asset_ids FROM plan""", recursive=True))
def _(spark, sf):
    return plan(spark, sf).select(
        "sample_id", "scene_name", "camera_id",
        F.concat_ws(",", F.transform("assets", lambda a: a["asset_id"])).alias("asset_ids"),
    )


@query("l2_ordered_jobs", with_tables(("plan",), "SELECT sample_id FROM plan ORDER BY sample_id", recursive=True))
def _(spark, sf):
    return planning.ordered_jobs(plan(spark, sf)).select("sample_id")


@query("a11_plan_summary", with_tables(("plan",), """
  SELECT count(*) AS job_count, (SELECT count(DISTINCT a) FROM (SELECT unnest(asset_ids) AS a FROM plan)) AS asset_count,
         CAST(count_if(len(asset_ids) > 1) AS BIGINT) AS combination_job_count, count(DISTINCT scene_name) AS scene_count,
         CAST(count_if(camera_id = '0') AS BIGINT) AS camera_0, CAST(count_if(camera_id = '5') AS BIGINT) AS camera_5
  FROM plan""", recursive=True))
def _(spark, sf):
    counts = F.col("camera_counts")
    return planning.plan_summary(plan(spark, sf)).select(
        "job_count", "asset_count", "combination_job_count", "scene_count",
        counts["0"].alias("camera_0"), counts["5"].alias("camera_5"),
    )
