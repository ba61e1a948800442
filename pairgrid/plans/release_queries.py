"""Queries over the union of batches and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairgrid.operators import release
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.registry import query

ORDER = ("batch", "sample_id")

define("deduped", ("batches",), """
  SELECT *, row_number() OVER w AS n, first_value(sample_id) OVER w AS canonical FROM batches
  WINDOW w AS (PARTITION BY gt, input, target ORDER BY batch, sample_id)""")


def _batches(spark, sf):
    return fx.batches(spark, sf)


@query("w2_dedup_union", with_tables(("deduped",), "SELECT batch, sample_id FROM deduped WHERE n = 1"))
def _(spark, sf):
    kept, _ = release.dedup_union(_batches(spark, sf), ORDER)
    return kept.select("batch", "sample_id")


@query("w2_exclusions", with_tables(("deduped",), "SELECT batch, sample_id, canonical FROM deduped WHERE n > 1"))
def _(spark, sf):
    _, dropped = release.dedup_union(_batches(spark, sf), ORDER)
    return dropped


define("rebatched", ("batches",), """
  SELECT batch, sample_id, gt, target, CASE WHEN batch > 0 AND d = 9 THEN sha256(input || 'y') ELSE input END AS input,
         CAST(batch AS VARCHAR) || '|' || sample_id AS place FROM batches""")
define("rebatched_rank", ("rebatched",), """
  SELECT *, row_number() OVER (PARTITION BY gt, input, target ORDER BY batch, sample_id) AS n FROM rebatched""")


@query("w2_conflicts", with_tables(("rebatched_rank",), """
  SELECT DISTINCT r.sample_id FROM rebatched_rank r JOIN rebatched_rank k ON k.sample_id = r.sample_id AND k.n = 1
    AND (k.batch, k.sample_id) < (r.batch, r.sample_id)
  WHERE (k.gt, k.input, k.target) <> (r.gt, r.input, r.target)"""))
def _(spark, sf):
    again = _batches(spark, sf).withColumn(
        "input", F.when((F.col("batch") > 0) & (F.col("d") == 9), F.sha2(F.concat("input", F.lit("y")), 256)).otherwise(F.col("input"))
    )
    return release.union_conflicts(again, ORDER)


@query("w2_release_violations", with_tables(("batches",), """
  SELECT sample_id, CASE WHEN d = 0 THEN 'missing_sample_id' || CASE WHEN q = 50 THEN ',invalid_content_hash' ELSE '' END
         ELSE 'invalid_content_hash' END AS codes
  FROM (SELECT CASE WHEN d = 0 THEN '' ELSE sample_id END AS sample_id, d, q FROM batches) WHERE d = 0 OR q = 50"""))
def _(spark, sf):
    broken = fx.batches(spark, sf).withColumns(
        {
            "sample_id": F.when(F.col("d") != 0, F.col("sample_id")).otherwise(""),
            "gt": F.when(F.col("q") != 50, F.col("gt")),
        }
    )
    return release.release_violations(broken).withColumn("codes", F.concat_ws(",", "codes"))


@query("j19_union_sources", with_tables(("records",), """
  SELECT 0 AS batch, 'root-a' AS source_root, sample_id FROM records WHERE camera_id <= '3'
  UNION ALL SELECT 1, 'root-b', sample_id FROM records WHERE camera_id >= '2'"""))
def _(spark, sf):
    r = fx.records(spark, sf).select("sample_id", "camera_id")
    parts = [(r.filter(F.col("camera_id") <= "3"), "root-a"), (r.filter(F.col("camera_id") >= "2"), "root-b")]
    return release.union_sources(parts).select("batch", "source_root", "sample_id")


@query("a14_publish_summary", with_tables(("deduped",), """
  SELECT count(*) AS input_record_count, CAST(count_if(n = 1) AS BIGINT) AS triplet_count, CAST(count_if(n = 1) * 3 AS BIGINT) AS image_count,
         CAST(count_if(n > 1) AS BIGINT) AS duplicate_exclusion_count FROM deduped"""))
def _(spark, sf):
    return release.publish_summary(*release.dedup_union(_batches(spark, sf), ORDER))


def _quarantined(spark, sf):
    r = fx.records(spark, sf).select("sample_id", "q", "d")
    ids = r.filter(F.col("q") == 49).select("sample_id").unionByName(
        r.filter((F.col("q") == 48) & (F.col("d") == 10)).select(F.concat("sample_id", F.lit("__gone")).alias("sample_id"))
    )
    return release.quarantine(r.select("sample_id"), ids)


@query("j18_quarantine", with_tables(("records",), """
  SELECT sample_id, CASE WHEN q = 49 THEN 'quarantined' ELSE 'retained' END AS part FROM records
  UNION ALL SELECT sample_id || '__gone', 'unknown' FROM records WHERE q = 48 AND d = 10"""))
def _(spark, sf):
    parts = dict(zip(("quarantined", "retained", "unknown"), _quarantined(spark, sf)))
    tagged = [df.withColumn("part", F.lit(name)) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("l4_first_unknown", with_tables(("records",), """
  SELECT sample_id || '__gone' AS sample_id FROM records WHERE q = 48 AND d = 10 ORDER BY sample_id || '__gone' LIMIT 5"""))
def _(spark, sf):
    return release.first_errors(_quarantined(spark, sf)[2], "sample_id")


@query("a16_quarantine_receipt", with_tables(("records",), """
  SELECT count(*) AS before_count, CAST(count_if(q = 49) AS BIGINT) AS candidate_count, CAST(count_if(q <> 49) AS BIGINT) AS retained_count
  FROM records"""))
def _(spark, sf):
    quarantined, retained, _ = _quarantined(spark, sf)
    return release.quarantine_receipt(quarantined, retained)


@query("u3_role_membership", with_tables(("files",), """
  SELECT name, array_to_string(list(DISTINCT role ORDER BY role), ',') AS roles FROM files GROUP BY 1 HAVING count(DISTINCT role) <> 3"""))
def _(spark, sf):
    return release.role_membership(fx.files(spark, sf)).withColumn("roles", F.concat_ws(",", "roles"))
