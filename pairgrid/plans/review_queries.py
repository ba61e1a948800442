"""Queries over review rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairgrid.functions.hashing import canonical_json
from pairgrid.operators import review
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.planning_queries import plan, single_jobs
from pairgrid.plans.registry import query
from pairgrid.session import staged


def _decided(spark, sf):
    return fx.decisions(spark, sf).withColumn("hard_failure", review.hard_failure(F.col("decision")))


@query("p12_hard_failure", with_tables(("decisions",), "SELECT sample_id, hard AS hard_failure FROM decisions"))
def _(spark, sf):
    return _decided(spark, sf).select("sample_id", "hard_failure")


@query("p13_conforms", with_tables(("decisions",), """
  SELECT sample_id, obj_no % 6 <> 0 AND obj_no % 7 <> 0 AS conforms FROM decisions"""))
def _(spark, sf):
    body = canonical_json(F.col("decision"))
    m = F.col("obj_no")
    raw = (
        F.when(m % 6 == 0, F.regexp_replace(body, '^[{]', '{"extra":1,'))
        .when(m % 7 == 0, F.substring(body, 1, 20))
        .otherwise(body)
    )
    return fx.decisions(spark, sf).select("sample_id", review.decision_conforms(raw).alias("conforms"))


@query("j4_accepted_jobs", with_tables(("plan", "decisions"), """
  SELECT sample_id FROM plan p WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT unnest(p.asset_ids) AS a) x LEFT JOIN (SELECT * FROM decisions WHERE least <> 4) d
      ON d.sample_id = x.a WHERE d.hard IS NULL OR d.hard)""", recursive=True))
def _(spark, sf):
    # Some assets were never reviewed; their jobs are refused too.
    reviewed = _decided(spark, sf).filter(F.col("least") != 4)
    return review.accepted_jobs(plan(spark, sf), reviewed).select("sample_id")


def _requests(spark, sf):
    rows, _ = review.asset_review_rows(single_jobs(spark, sf))
    return rows


@query("a9_asset_reviews", with_tables(("jobs",), """
  SELECT DISTINCT asset_id AS sample_id, 'img/' || obj_id AS source_image FROM jobs"""))
def _(spark, sf):
    return _requests(spark, sf).select("sample_id", F.col("review_images")["source"].alias("source_image"))


@query("a9_review_conflicts", with_tables(("jobs",), """
  SELECT asset_id AS sample_id, 'conflicting_evidence' AS code FROM jobs GROUP BY 1
  HAVING count(DISTINCT frame_index > 6) > 1"""))
def _(spark, sf):
    # Late frames cite another image, so an asset seen early and late has two versions.
    other = F.create_map(F.lit("source"), F.lit("img/late"))
    jobs = single_jobs(spark, sf).withColumn("review_images", F.when(F.col("frame_index") > 6, other).otherwise(F.col("review_images")))
    _, conflicts = review.asset_review_rows(jobs)
    return conflicts


@query("a10_pair_reviews", with_tables(("records",), """
  SELECT sample_id, 'gt/' || sample_id AS gt_path, '{"camera_id":"' || camera_id || '","selected_obj_ids":'
         || CAST(to_json(selected) AS VARCHAR) || '}' AS review_context FROM records"""))
def _(spark, sf):
    rendered = fx.records(spark, sf).select(
        "sample_id", "camera_id", F.col("selected").alias("selected_obj_ids"),
        F.create_map(*[x for r in fx.ROLES for x in (F.lit(r), F.concat(F.lit(f"{r}/"), "sample_id"))]).alias("paths"),
    )
    return review.pair_review_rows(rendered).select("sample_id", F.col("review_images")["gt"].alias("gt_path"), "review_context")


def _rounds(spark, sf):
    """Requests and an earlier round: some answers are stale, failed or unbound."""
    m = F.col("obj_no")
    requests = fx.decisions(spark, sf).select("sample_id", "request_sha256")
    prior = _decided(spark, sf).filter(F.col("least") != 2).select(
        "sample_id",
        F.when(m % 5 == 0, F.sha2("sample_id", 256)).otherwise(F.col("request_sha256")).alias("request_sha256"),
        "request_error",
        "hard_failure",
        (m % 7 != 0).alias("self_bound"),
    )
    return review.reuse_decisions(requests, prior)


define("reused", ("decisions",), """
  SELECT * FROM decisions WHERE least <> 2 AND obj_no % 5 <> 0 AND obj_no % 7 <> 0 AND request_error IS NULL""")


@query("j6_reuse", with_tables(("reused",), """
  SELECT sample_id, sample_id IN (SELECT sample_id FROM reused) AS reused FROM decisions"""))
def _(spark, sf):
    kept, pending = _rounds(spark, sf)
    return kept.select("sample_id", F.lit(True).alias("reused")).unionByName(
        pending.select("sample_id", F.lit(False).alias("reused"))
    )


@query("a12_review_summary", with_tables(("reused",), """
  SELECT count(*) AS reviewed_count, CAST(count_if(r) AS BIGINT) AS reused_count, CAST(count_if(NOT r) AS BIGINT) AS requested_count,
         CAST(count_if(NOT hard) AS BIGINT) AS accepted_count, CAST(count_if(hard) AS BIGINT) AS candidate_count,
         CAST(count_if(NOT r AND request_error IS NOT NULL) AS BIGINT) AS request_error_count
  FROM (SELECT *, sample_id IN (SELECT sample_id FROM reused) AS r FROM decisions)"""))
def _(spark, sf):
    kept, pending = _rounds(spark, sf)
    asked = pending.join(_decided(spark, sf).select("sample_id", "hard_failure", "request_error"), "sample_id")
    columns = ["sample_id", "hard_failure", "request_error"]
    both = kept.select(*columns, F.lit(True).alias("reused")).unionByName(asked.select(*columns, F.lit(False).alias("reused")))
    return review.review_summary(both)


def _toy_scorer(row: dict) -> dict:
    number = int(row["sample_id"][1:])
    if number % 10 == 0:
        raise TimeoutError("no answer")
    answer = {
        "decision": "reject" if number % 3 == 0 else "accept", "same_identity": True, "broken_or_doubled_asset": False,
        "orientation_valid": True, "scale_valid": True, "grounding_valid": True, "severe_occlusion_error": False,
        "confidence": 0.5, "reason": "",
    }
    if number % 14 == 1:
        answer.pop("reason")
    return answer


@query("e1_score", with_tables(("jobs",), """
  SELECT DISTINCT asset_id AS sample_id,
         CASE WHEN obj_no % 10 = 0 OR obj_no % 14 = 1 THEN 'unverifiable' WHEN obj_no % 3 = 0 THEN 'reject' ELSE 'accept' END AS decision,
         obj_no % 10 = 0 OR obj_no % 14 = 1 OR obj_no % 3 = 0 AS hard_failure,
         CASE WHEN obj_no % 10 = 0 THEN 'TimeoutError: no answer'
              WHEN obj_no % 14 = 1 THEN 'response keys differ from the schema' END AS request_error FROM jobs"""))
def _(spark, sf):
    scored = review.score(review.with_request_sha(_requests(spark, sf)), _toy_scorer)
    return scored.select("sample_id", "decision.decision", "hard_failure", "request_error")


@query("e1_second_round", with_tables(("jobs",), """
  SELECT DISTINCT asset_id AS sample_id FROM jobs WHERE obj_no % 10 = 0 OR obj_no % 14 = 1"""))
def _(spark, sf):
    # A second round over the same requests asks only those whose first answer failed.
    requests = staged(review.with_request_sha(_requests(spark, sf)), "requests")
    first = staged(review.score(requests, _toy_scorer), "scored")
    bound = first.withColumn("self_bound", review.decision_sha(F.col("decision")) == F.col("decision_sha256"))
    _, pending = review.reuse_decisions(requests, bound)
    return pending.select("sample_id")
