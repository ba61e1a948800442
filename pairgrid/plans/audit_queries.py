"""Queries over the audits."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from pairgrid.functions.hashing import bound_to_itself, kind_of, manifest_digest, value_sha
from pairgrid.functions.semantics import ROLES
from pairgrid.operators import audit, rings
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.planning_queries import single_jobs
from pairgrid.plans import ring_queries as _ring_queries  # noqa: F401  (defines the ring expressions)
from pairgrid.plans.registry import query
from pairgrid.session import staged


def _observed(spark, sf):
    return fx.files(spark, sf)


define("expected_files", ("records",), """
  SELECT unnest(['gt','input','target']) AS role, sample_id || '.png' AS name FROM records""")


@query("j12_reconcile", with_tables(("expected_files", "files"), """
  SELECT role, name, 'missing' AS side FROM (SELECT * FROM expected_files EXCEPT SELECT role, name FROM files)
  UNION ALL SELECT role, name, 'extra' FROM (SELECT role, name FROM files EXCEPT SELECT * FROM expected_files)"""))
def _(spark, sf):
    expected = audit.content_rows(fx.records(spark, sf)).select("role", "name")
    return audit.reconcile(expected, _observed(spark, sf), ["role", "name"], ("role", ROLES))


@query("j12_reconcile_counts", with_tables(("records", "files"), """
  SELECT (SELECT count(*) FROM records WHERE NOT (d > 0 OR q > 10)) * 3 AS missing_count,
         (SELECT count(DISTINCT scene_name) FROM records) AS extra_count"""))
def _(spark, sf):
    expected = audit.content_rows(fx.records(spark, sf)).select("role", "name")
    return audit.reconcile_counts(audit.reconcile(expected, _observed(spark, sf), ["role", "name"], ("role", ROLES)))


define("content_errors", ("records", "files"), """
  SELECT r.sample_id, r.role, CASE WHEN f.name IS NULL THEN 'missing_file' ELSE 'hash_mismatch' END AS code
  FROM (SELECT sample_id, unnest(['gt','input','target']) AS role, unnest([gt, input, target]) AS expected FROM records) r
  LEFT JOIN files f ON f.role = r.role AND f.name = r.sample_id || '.png'
  WHERE f.name IS NULL OR f.sha256 <> r.expected""")


@query("j13_content_errors", with_tables(("content_errors",), "SELECT * FROM content_errors"))
def _(spark, sf):
    return audit.content_errors(audit.content_sets(fx.records(spark, sf)), _observed(spark, sf))


def _results(spark, sf):
    """Jobs and renderer results, some lost, repeated, incomplete or bound to another job."""
    jobs = single_jobs(spark, sf)
    q = F.conv(F.substring("job_sha256", 1, 2), 16, 10).cast("int")
    sound = jobs.select(
        "sample_id",
        F.when(q == 1, F.sha2("job_sha256", 256)).otherwise(F.col("job_sha256")).alias("job_sha256"),
        F.when(q == 2, F.array()).otherwise(F.col("selected_obj_ids")).alias("selected_obj_ids"),
        F.when(q == 3, F.lit("9")).otherwise(F.col("camera_id")).alias("camera_id"),
        F.when(q == 4, F.lit(-1)).otherwise(F.col("frame_index")).alias("frame_index"),
        F.when(q == 5, F.lit("failed")).otherwise(F.lit("complete")).alias("status"),
        F.when(q == 6, F.create_map(F.lit("main"), F.lit("y")))
        .otherwise(F.create_map(F.lit("other"), F.lit("y"), F.lit("main"), F.lit("x")))
        .alias("checkpoint_sha256"),
        q.alias("q"),
    )
    twice = sound.filter("q = 7")
    strange = sound.filter("q = 8").withColumn("sample_id", F.concat("sample_id", F.lit("__new")))
    return jobs, sound.filter("q <> 0").unionByName(twice).unionByName(strange).drop("q")


define("job_hashes", ("jobs",), """
  SELECT *, CAST('0x' || substr(job_sha256, 1, 2) AS INT) AS h FROM (SELECT sample_id, sha256(
    '{"assets":[{"asset_id":"' || asset_id || '","asset_sha256":"' || sha256('ply|' || obj_no) || '","official_dimensions_m":["'
    || CAST((40 + obj_no % 5) / 10.0::DOUBLE AS VARCHAR) || '","' || CAST((18 + obj_no % 3) / 10.0::DOUBLE AS VARCHAR) || '","'
    || CAST((15 + obj_no % 4) / 10.0::DOUBLE AS VARCHAR) || '"]}],"camera_id":"' || camera_id || '","frame_index":' || frame_index
    || ',"sample_id":"' || sample_id || '","scene_name":"' || scene_name || '","window_id":"' || window_id || '"}') AS job_sha256
  FROM jobs)""")


@query("j5_bind_results", with_tables(("job_hashes",), """
  SELECT CASE WHEN u = 2 THEN sample_id || '__new' ELSE sample_id END AS sample_id, CASE WHEN u = 2 THEN 'unknown_result' ELSE
         CASE h WHEN 0 THEN 'missing_result' WHEN 1 THEN 'job_hash_differs' WHEN 2 THEN 'objects_differ' WHEN 3 THEN 'camera_differs'
                WHEN 4 THEN 'frame_differs' WHEN 5 THEN 'incomplete_result' WHEN 6 THEN 'checkpoints_differ'
                WHEN 7 THEN 'duplicate_result' END END AS codes
  FROM job_hashes, range(1, 3) t(u) WHERE (u = 1 AND h < 8) OR (u = 2 AND h = 8)"""))
def _(spark, sf):
    jobs, results = _results(spark, sf)
    bad = audit.bind_results(jobs, results, {"main": "x", "other": "y"})
    return bad.withColumn("codes", F.concat_ws(",", "codes"))


# Layers with an occlusion outcome, nested under their record.
def _layered(spark, sf):
    x = fx.layers(spark, sf)
    layer = F.struct(
        F.col("obj_id").alias("obj_id"), "instance_token", "asset_sha256", "official_dimensions_m", "forward_axis", "quality",
        F.struct(
            (F.col("pk") % 59 == 0).alias("renderer_occlusion_regression"),
            F.when(F.col("pk") % 5 == 0, F.lit(20)).otherwise(F.lit(0)).alias("pixels"),
            (F.col("q") > 4).alias("applied"),
        ).alias("occlusion"),
    )
    return x.groupBy("sample_id", "scene_name", "frame_index", "camera_id").agg(
        F.sort_array(F.collect_list(F.struct("obj_id", layer.alias("layer")))).alias("_l"),
        F.max("q").alias("q"), F.max("d").alias("d"), F.max("t").alias("t"), F.max("pk").alias("pk"),
    ).select(
        "sample_id", "scene_name", "frame_index", "q", "d", "t", "pk",
        F.when((F.col("d") == 1), F.lit("7")).otherwise(F.col("camera_id")).alias("camera_id"),
        F.when(F.col("t") != 1, F.transform("_l", lambda v: v["layer"])).alias("asset_layers"),
    )


def _sealed(records):
    """Records with their own hash. Some have none (as those with a number that JSON can't hold), and some are changed after."""
    own = F.struct(*records.columns)
    late = F.col("q") == 50
    return records.withColumn("record_sha256", value_sha(own, kind_of(records, own))).withColumns(
        {
            "record_sha256": F.when(late & (F.col("pk") % 2 == 0), F.sha2("sample_id", 256)).when(
                F.col("q") != 44, F.coalesce("record_sha256", F.when(late, F.sha2("sample_id", 256)))
            ),
            "frame_index": F.when(late & (F.col("pk") % 2 == 1), F.col("frame_index") + 1).otherwise(F.col("frame_index")),
        }
    )


def _reviews(records):
    good = F.struct(
        F.when(F.col("q") == 49, F.lit("reject")).otherwise(F.lit("accept")).alias("decision"),
        F.lit(True).alias("same_identity"), F.lit(False).alias("broken_or_doubled_asset"), F.lit(True).alias("orientation_valid"),
        F.lit(True).alias("scale_valid"), F.lit(True).alias("grounding_valid"), F.lit(False).alias("severe_occlusion_error"),
        F.lit(0.5).alias("confidence"), F.lit("").alias("reason"),
    )
    rows = records.select("sample_id", good.alias("decision"), F.col("q").isin(48, 49).alias("hard_failure"), "q", "pk")
    own = F.struct("sample_id", "decision", "hard_failure")
    # The forty-seventh are changed after they were signed: the confidence, or the hash.
    late = F.col("q") == 47
    return rows.withColumn("decision_sha256", value_sha(own, kind_of(rows, own))).select(
        "sample_id",
        F.when(late & (F.col("pk") % 2 == 0), F.col("decision").withField("confidence", F.lit(0.25))).otherwise(F.col("decision")).alias("decision"),
        "hard_failure",
        F.when(late & (F.col("pk") % 2 == 1), F.sha2("sample_id", 256)).otherwise(F.col("decision_sha256")).alias("decision_sha256"),
    )


define("layered", ("gate",), """
  SELECT sample_id, max(q) AS q, max(d) AS d, max(t) AS t,
         CASE WHEN max(t) = 1 THEN [] ELSE list_distinct(flatten(list(list_filter([
           CASE WHEN q <= 2 THEN 'incomplete_asset_identity' END,
           CASE WHEN dim_h <= 0 OR forward_axis <> '+X' THEN 'invalid_dimensions_or_axis' END,
           CASE WHEN NOT geometry_ok THEN 'geometry_candidate' END,
           CASE WHEN pk % 59 = 0 THEN 'occlusion_regression_candidate' END,
           CASE WHEN pk % 5 = 0 AND q <= 4 THEN 'unverified_partial_occlusion' END], lambda c: c IS NOT NULL)))) END AS found
  FROM gate GROUP BY sample_id""")

define("record_errors", ("layered",), """
  SELECT sample_id, q, list_sort(list_concat(found, list_filter([
    CASE WHEN d = 1 THEN 'invalid_identity_or_camera' END,
    CASE WHEN t = 1 THEN 'no_asset_layers' END,
    CASE WHEN q IN (47, 48) THEN 'visual_review_binding_mismatch' WHEN q = 49 THEN 'visual_review_candidate' END,
    CASE WHEN q = 50 THEN 'record_binding_mismatch' END], lambda c: c IS NOT NULL))) AS errors FROM layered""")


@query("p24_record_errors", with_tables(("record_errors",), """
  SELECT sample_id, array_to_string(errors, ',') AS errors FROM record_errors"""))
def _(spark, sf):
    records = staged(_sealed(_layered(spark, sf)), "sealed")
    return audit.record_errors(records, _reviews(records)).withColumn("errors", F.concat_ws(",", "errors"))


@query("p24_missing_reviews", with_tables(("record_errors",), """
  SELECT sample_id, array_to_string(CASE WHEN q <= 12 THEN list_sort(list_append(errors, 'visual_review_missing')) ELSE errors END, ',') AS errors
  FROM record_errors"""))
def _(spark, sf):
    records = staged(_sealed(_layered(spark, sf)), "sealed")
    return audit.record_errors(records, _reviews(records.filter("q > 12"))).withColumn("errors", F.concat_ws(",", "errors"))


@query("j15_reviews", with_tables(("record_errors",), """
  SELECT sample_id, 'missing' AS side FROM record_errors WHERE q <= 12
  UNION ALL SELECT sample_id || '__stray', 'extra' FROM record_errors WHERE q = 30"""))
def _(spark, sf):
    records = _layered(spark, sf)
    reviews = _reviews(records.filter("q > 12"))
    stray = reviews.join(records.filter("q = 30").select("sample_id"), "sample_id").withColumn("sample_id", F.concat("sample_id", F.lit("__stray")))
    return audit.review_membership(records, reviews.unionByName(stray))


@query("j15_bindings", with_tables(("record_errors",), """
  SELECT sample_id, q <> 47 AS bound FROM record_errors WHERE q > 12"""))
def _(spark, sf):
    reviews = _reviews(_layered(spark, sf).filter("q > 12"))
    own = F.struct(*reviews.columns)
    return reviews.select("sample_id", bound_to_itself(own, kind_of(reviews, own)).alias("bound"))


define("rerun", ("records",), """
  SELECT sample_id, gt, input, target, q FROM records
  UNION ALL SELECT sample_id || '__again', gt, input, target, q FROM records WHERE q >= 45""")


def _rerun(spark, sf):
    """Records with large views rendered again: same content under a later id."""
    r = fx.records(spark, sf)
    return r.unionByName(r.filter(F.col("q") >= 45).withColumn("sample_id", F.concat("sample_id", F.lit("__again"))))


@query("w1_duplicates", with_tables(("rerun",), """
  SELECT sample_id FROM (SELECT sample_id, row_number() OVER (PARTITION BY gt, input, target ORDER BY sample_id) AS n FROM rerun)
  WHERE n > 1"""))
def _(spark, sf):
    return audit.duplicate_triplets(_rerun(spark, sf)).select("sample_id")


def _release(spark, sf):
    """Layered records with the contents of their files, of which some are altered."""
    records = staged(
        _sealed(
            _layered(spark, sf).withColumn(
                "content_sha256",
                F.struct(
                    F.sha2(F.concat(F.lit("g"), F.col("pk").cast("string")), 256).alias("gt"),
                    F.sha2(F.concat(F.lit("i"), F.col("pk").cast("string")), 256).alias("input"),
                    F.sha2(F.concat(F.lit("t"), F.col("pk").cast("string")), 256).alias("target"),
                ),
            )
        ),
        "layered",
    )
    altered = F.col("content_sha256").withField("gt", F.when(F.col("d") == 0, F.sha2("content_sha256.gt", 256)).otherwise(F.col("content_sha256.gt")))
    stored = audit.content_rows(records.select("sample_id", altered.alias("content_sha256")))
    return records, stored.select("role", "name", F.col("expected").alias("sha256"))


define("release_reasons", ("record_errors", "gate"), """
  SELECT sample_id, list_sort(list_concat(errors, list_filter([
           CASE WHEN d = 0 THEN 'hash_mismatch' END,
           CASE WHEN n > 1 THEN 'duplicate_triplet_content' END], lambda c: c IS NOT NULL))) AS reasons
  FROM (SELECT e.sample_id, e.errors, p.d, row_number() OVER (PARTITION BY p.pk ORDER BY e.sample_id) AS n
        FROM record_errors e JOIN (SELECT sample_id, max(pk) AS pk, max(d) AS d FROM gate GROUP BY 1) p ON p.sample_id = e.sample_id)""")


@query("g5_audit_candidates", with_tables(("release_reasons",), """
  SELECT sample_id, array_to_string(reasons, ',') AS reasons FROM release_reasons WHERE len(reasons) > 0"""))
def _(spark, sf):
    records, files = _release(spark, sf)
    _, candidates = audit.audit_release(records, files, _reviews(records))
    return candidates.withColumn("reasons", F.concat_ws(",", "reasons"))


@query("g5_audit_accepted", with_tables(("release_reasons",), "SELECT sample_id FROM release_reasons WHERE len(reasons) = 0"))
def _(spark, sf):
    records, files = _release(spark, sf)
    accepted, _ = audit.audit_release(records, files, _reviews(records))
    return accepted.select("sample_id")


@query("a13_audit_summary", with_tables(("release_reasons",), """
  SELECT count(*) AS record_count, count(*) * 3 AS image_count, true AS all_images_checked,
         CAST(count_if(len(reasons) = 0) AS BIGINT) AS accepted_count, CAST(count_if(len(reasons) > 0) AS BIGINT) AS candidate_count,
         CAST(count_if(list_contains(reasons, 'duplicate_triplet_content')) AS BIGINT) AS duplicate_triplet_count,
         'candidates_excluded_from_acceptance' AS status FROM release_reasons"""))
def _(spark, sf):
    records, files = _release(spark, sf)
    _, candidates = audit.audit_release(records, files, _reviews(records))
    return audit.audit_summary(records, staged(candidates, "candidates"), audit.content_rows(records))


def _opportunities(spark, sf):
    jobs = single_jobs(spark, sf)
    a = F.get("assets", F.lit(0))
    key = F.format_string("%06d:c%s", "frame_index", "camera_id")
    # The frozen index is a map per object; cells of camera 5 in frame 9 were never usable.
    usable = ~((F.col("frame_index") == 9) & (F.col("camera_id") == "5"))
    number = F.substring("obj_id", 5, 20).cast("bigint")
    frozen = (
        jobs.groupBy("scene_name", "obj_id")
        .agg(F.map_from_entries(F.collect_list(F.struct(key, usable))).alias("target_usable_by_frame_camera"), F.max(a).alias("a"))
        .select(
            "scene_name", "obj_id", "target_usable_by_frame_camera",
            F.struct(
                F.when(number % 8 == 0, F.lit("other")).otherwise(F.col("a.instance_token")).alias("instance_token"),
                F.when(number % 9 == 0, F.lit("other")).otherwise(F.col("a.asset_sha256")).alias("asset_sha256"),
            ).alias("exact_asset_binding"),
            F.transform(
                "a.official_dimensions_m", lambda v: v * F.when(number % 10 == 0, F.lit(1.01)).otherwise(F.lit(1.000001))
            ).alias("official_dimensions_m"),
        )
    )
    return jobs, audit.opportunity_index(frozen)


@query("j16_opportunities", with_tables(("jobs",), """
  SELECT * FROM (SELECT sample_id, obj_id, CASE WHEN frame_index = 9 AND camera_id = '5' THEN 'no_opportunity' ELSE
    array_to_string(list_filter([CASE WHEN obj_no % 8 = 0 THEN 'token_differs' END,
      CASE WHEN obj_no % 9 = 0 THEN 'hash_differs' END, CASE WHEN obj_no % 10 = 0 THEN 'dimensions_differ' END],
      lambda c: c IS NOT NULL), ',') END AS codes FROM jobs) WHERE codes <> ''"""))
def _(spark, sf):
    jobs, index = _opportunities(spark, sf)
    return audit.bind_opportunities(jobs, index).withColumn("codes", F.concat_ws(",", "codes"))


@query("a18_background", with_tables(("layers",), """
  SELECT sample_id FROM layers GROUP BY 1
  HAVING count(DISTINCT CASE WHEN q = 50 THEN 1 ELSE 0 END) > 1 OR count(DISTINCT CASE WHEN d = 10 THEN 1 ELSE 0 END) > 1"""))
def _(spark, sf):
    x = fx.layers(spark, sf).select(
        "sample_id",
        F.sha2(F.concat("sample_id", F.when(F.col("q") == 50, "b").otherwise("a")), 256).alias("target_sha256"),
        F.sha2(F.concat("sample_id", F.when(F.col("d") == 10, "b").otherwise("a")), 256).alias("gt_sha256"),
    )
    return audit.background_conflicts(x)


@query("a19_cleanup", with_tables(("layers",), """
  SELECT sample_id, bool_and(q > 2) AS observation_technical_usable, bool_and(d > 0) AS quality_gate_pass,
         string_agg(sha256(obj_id), ',' ORDER BY obj_id) AS sources,
         sha256('{"observation_technical_usable":' || bool_and(q > 2) || ',"policy":"union_of_hash_bound_legacy_actor_cleanup_masks_v1","quality_gate_pass":'
           || bool_and(d > 0) || ',"schema_version":1,"source_decision_sha256":["' || string_agg(sha256(obj_id), '","' ORDER BY obj_id) || '"]}') AS decision_sha256
  FROM layers GROUP BY 1"""))
def _(spark, sf):
    x = fx.layers(spark, sf).select(
        "sample_id", F.col("obj_id").alias("ord"), F.when(F.col("q") > 2, F.lit(True)).alias("usable"), (F.col("d") > 0).alias("passed"),
        F.sha2("obj_id", 256).alias("decision_sha256"),
    )
    return audit.cleanup_rollup(x).select(
        "sample_id", "observation_technical_usable", "quality_gate_pass", F.concat_ws(",", "source_decision_sha256").alias("sources"),
        "decision_sha256",
    )


@query("a17_digest", with_tables(("records",), """
  SELECT n AS row_count, sha256(n || '|' || l0 || '|' || l1 || '|' || l2 || '|' || l3) AS digest FROM (
    SELECT count(*) AS n, sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS l0, sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)) AS l1,
           sum(CAST('0x' || substr(h, 31, 15) AS HUGEINT)) AS l2, sum(CAST('0x' || substr(h, 46, 15) AS HUGEINT)) AS l3
    FROM (SELECT sha256(sample_id || chr(31) || frame_index || chr(31) || gt) AS h FROM records))"""))
def _(spark, sf):
    return manifest_digest(fx.records(spark, sf), ["sample_id", "frame_index", "gt"])


# Rings, then damaged: each fault in the rows whose numbers pick it.
def _damaged(spark, sf):
    records = fx.records(spark, sf)
    jobs = fx.visibility_jobs(spark, sf)
    groups = staged(rings.ring_records(rings.accepted_groups(rings.ring_candidates(records, jobs))), "groups")
    h = F.col("h")

    def view(v):
        broken = F.when(h == 1, v.withField("camera_name", F.lit("CAM_X")))
        broken = broken.when(h == 2, v.withField("baseline_sample_id", F.lit("nobody")))
        broken = broken.when(
            h == 3, v.withField("content_sha256", v["content_sha256"].withField("gt", F.sha2(v["content_sha256"]["gt"], 256)))
        )
        broken = broken.when(h == 4, v.withField("applied_asset_ids", F.array(F.lit("uid-none"))))
        broken = broken.when(h == 5, v.withField("files", v["files"].withField("gt", F.lit("x.png"))))
        broken = broken.when(
            h == 6, v.withField("content_sha256", v["content_sha256"].withField("input", F.lit("short")))
        )
        broken = broken.when(h == 7, v.withField("content_sha256", v["content_sha256"].withField("target", F.lit(None).cast("string"))))
        broken = broken.when(h == 8, v.withField("source_pair_sample_id", F.lit(None).cast("string")))
        return broken.otherwise(v)

    number = F.conv(F.substring(F.sha2("group_id", 256), 1, 2), 16, 10).cast("int")
    damaged = (
        groups.withColumn("h", number)
        .withColumn("views", F.transform("views", view))
        .withColumn("views", F.when(h == 9, F.slice("views", 2, 5)).otherwise(F.col("views")))
        .withColumn("selected_asset_ids", F.when(h == 10, F.array(F.lit("uid-none"))).otherwise(F.col("selected_asset_ids")))
        .withColumn("group_id", F.when(h == 11, F.concat("group_id", F.lit("x"))).otherwise(F.col("group_id")))
        .withColumn("record_sha256", F.when(h == 12, F.col("record_sha256")).otherwise(rings.ring_record_sha()))
        .withColumn("frame_index", F.when(h == 12, F.col("frame_index") + 100).otherwise(F.col("frame_index")))
        .drop("h")
    )
    signed = rings.asset_signature(records, rings.alias_table(jobs), within=["scene_name"])
    return damaged, signed, rings.visibility(jobs), rings.asset_categories(jobs)


define("group_pick", ("outcomes",), """
  SELECT *, CAST('0x' || substr(sha256(group_id), 1, 2) AS INT) AS h FROM outcomes WHERE reason IS NULL""")

define("group_facts", ("group_pick", "matched"), """
  SELECT g.group_id, g.h, count_if(m.pair_id IS NOT NULL) AS edited, count_if(m.pair_id IS NULL) AS plain
  FROM group_pick g JOIN matched m ON m.scene_name = g.scene_name AND m.frame_index = g.frame_index AND m.sig = g.sig GROUP BY ALL""")

define("group_errors", ("group_facts",), """
  SELECT CASE WHEN h = 11 THEN group_id || 'x' ELSE group_id END AS group_id, array_to_string(list_sort(list_filter(CASE h
    WHEN 1 THEN ['camera_name_mismatch']
    WHEN 2 THEN ['baseline_source_missing']
    WHEN 3 THEN ['baseline_source_binding_mismatch', CASE WHEN edited > 0 THEN 'pair_source_binding_mismatch' END]
    WHEN 4 THEN ['visibility_binding_mismatch', CASE WHEN edited > 0 THEN 'pair_source_binding_mismatch' END,
                 CASE WHEN plain > 0 THEN 'invisible_view_was_edited' END]
    WHEN 5 THEN ['flat_filename_mismatch']
    WHEN 6 THEN ['invalid_content_hash', CASE WHEN edited > 0 THEN 'pair_source_binding_mismatch' END,
                 CASE WHEN plain > 0 THEN 'invisible_view_was_edited' END]
    WHEN 7 THEN ['role_membership_incomplete']
    WHEN 8 THEN [CASE WHEN edited > 0 THEN 'visible_view_has_no_asset_pair' END]
    WHEN 9 THEN ['camera_ring_incomplete']
    WHEN 10 THEN ['group_id_mismatch', 'invalid_group_identity', CASE WHEN edited > 0 THEN 'visibility_binding_mismatch' END]
    WHEN 11 THEN ['group_id_mismatch', 'flat_filename_mismatch']
    WHEN 12 THEN ['record_binding_mismatch', 'group_id_mismatch', 'baseline_source_binding_mismatch',
                  CASE WHEN edited > 0 THEN 'visibility_binding_mismatch' END,
                  CASE WHEN edited > 0 THEN 'pair_source_binding_mismatch' END]
    ELSE [] END, lambda c: c IS NOT NULL)), ',') AS errors FROM group_facts""")


@query("p25_group_errors", with_tables(("group_errors",), "SELECT * FROM group_errors"))
def _(spark, sf):
    return audit.group_errors(*_damaged(spark, sf)).withColumn("errors", F.concat_ws(",", "errors"))


def _ring_release(spark, sf):
    records = fx.records(spark, sf)
    jobs = fx.visibility_jobs(spark, sf)
    groups = staged(rings.ring_records(rings.accepted_groups(rings.ring_candidates(records, jobs))), "groups")
    declared = audit.ring_files(groups)
    digit = F.substring(F.sha2("name", 256), 1, 2)
    files = declared.filter(digit != "00").select(
        "name", F.when(digit == "01", F.sha2("expected", 256)).otherwise(F.col("expected")).alias("sha256")
    )
    signed = rings.asset_signature(records, rings.alias_table(jobs), within=["scene_name"])
    return groups, audit.audit_rings(groups, signed, rings.visibility(jobs), rings.asset_categories(jobs), files)


define("ring_file_names", ("ring_views",), """
  SELECT unnest([replace(input_file, '__input.png', '__gt.png'), input_file, replace(input_file, '__input.png', '__target.png')]) AS name
  FROM ring_views""")

define("ring_findings", ("ring_file_names",), """
  SELECT name AS subject, CASE substr(sha256(name), 1, 2) WHEN '00' THEN 'not_regular_file' ELSE 'hash_mismatch' END AS errors
  FROM ring_file_names WHERE substr(sha256(name), 1, 2) IN ('00', '01')
  UNION ALL
  SELECT '__release__', 'flat_png_membership_mismatch' FROM ring_file_names WHERE substr(sha256(name), 1, 2) = '00' HAVING count(*) > 0""")


@query("g6_audit_rings", with_tables(("ring_findings",), "SELECT * FROM ring_findings"))
def _(spark, sf):
    _, findings = _ring_release(spark, sf)
    return findings.withColumn("errors", F.concat_ws(",", "errors"))


@query("a16_ring_audit_summary", with_tables(("ring_findings",), """
  SELECT 'fail' AS status, (SELECT count(*) FROM outcomes WHERE reason IS NULL) AS group_count,
         (SELECT count(*) FROM outcomes WHERE reason IS NULL) * 18 AS expected_image_count,
         (SELECT count(*) FROM ring_file_names) AS checked_image_count, true AS all_images_checked,
         (SELECT count(*) FROM ring_findings) AS candidate_count"""))
def _(spark, sf):
    return audit.ring_audit_summary(*_ring_release(spark, sf))


def _toy_worker(rows: pd.DataFrame) -> pd.DataFrame:
    """One row a batch: what it was handed."""
    ids = rows["sample_id"]
    first = {c: [rows[c].iat[0]] for c in ("scene_name", "window_id")}
    return pd.DataFrame({**first, "size": [len(rows)], "first_id": [ids.min()], "last_id": [ids.max()]})


@query("e2_run_batches", with_tables(("jobs",), """
  SELECT scene_name, window_id, count(*) AS size, min(sample_id) AS first_id, max(sample_id) AS last_id FROM jobs GROUP BY ALL"""))
def _(spark, sf):
    jobs = single_jobs(spark, sf).select("sample_id", "scene_name", "window_id")
    return audit.run_batches(jobs, _toy_worker, "scene_name STRING, window_id STRING, size LONG, first_id STRING, last_id STRING")


def _toy_stream(batches):
    """One row a window, from its batches in order."""
    size, first, last = 0, None, None
    for batch in batches:
        size += batch.num_rows
        first = first if first is not None else {c: batch.column(c)[0].as_py() for c in batch.schema.names}
        last = batch.column("sample_id")[-1].as_py()
    yield pa.RecordBatch.from_pylist(
        [{"scene_name": first["scene_name"], "window_id": first["window_id"], "size": size, "first_id": first["sample_id"], "last_id": last}]
    )


@query("e2_run_windows", with_tables(("jobs",), """
  SELECT scene_name, window_id, count(*) AS size, min(sample_id) AS first_id, max(sample_id) AS last_id FROM jobs GROUP BY ALL"""))
def _(spark, sf):
    jobs = single_jobs(spark, sf).select("sample_id", "scene_name", "window_id")
    return audit.run_windows(jobs, _toy_stream, "scene_name STRING, window_id STRING, size LONG, first_id STRING, last_id STRING")
