"""Review rounds: what to ask, what to reuse, and which jobs pass."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairgrid.functions.hashing import canonical_json, canonical_sha, sha
from pairgrid.functions.semantics import blank, first_text, is_true, not_true, text

# The closed schema of a decision.
DECISION_SCHEMA = (
    "decision STRING, same_identity BOOLEAN, broken_or_doubled_asset BOOLEAN, orientation_valid BOOLEAN, "
    "scale_valid BOOLEAN, grounding_valid BOOLEAN, severe_occlusion_error BOOLEAN, confidence DOUBLE, reason STRING"
)
DECISION_KEYS = tuple(part.split()[0] for part in DECISION_SCHEMA.split(", "))
MUST_HOLD = ("same_identity", "orientation_valid", "scale_valid", "grounding_valid")
MUST_NOT_HOLD = ("broken_or_doubled_asset", "severe_occlusion_error")


def hard_failure(decision: Column) -> Column:
    """Anything but a clean acceptance; confidence plays no part."""
    failed = ~F.coalesce(decision["decision"] == "accept", F.lit(False))
    for name in MUST_HOLD:
        failed = failed | not_true(decision[name])
    for name in MUST_NOT_HOLD:
        failed = failed | is_true(decision[name])
    return failed


def decision_conforms(raw: Column) -> Column:
    """Does the JSON text hold exactly the keys of the schema?"""
    wanted = F.array(*[F.lit(k) for k in sorted(DECISION_KEYS)])
    return F.coalesce(F.sort_array(F.json_object_keys(raw)) == wanted, F.lit(False))


def accepted_jobs(jobs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Jobs whose every asset has a review, and none of whose reviews is a hard failure."""
    good = F.bool_and(~F.coalesce("hard_failure", F.lit(True)))
    passed = decisions.groupBy(F.col("sample_id").alias("asset_id")).agg(good.alias("_good")).filter("_good").select("asset_id")
    refused = (
        jobs.select("sample_id", F.explode("assets").alias("a"))
        .select("sample_id", "a.asset_id")
        .join(passed, "asset_id", "left_anti")
        .select("sample_id")
        .distinct()
    )
    return jobs.join(refused, "sample_id", "left_anti")


def sorted_map(c: Column) -> Column:
    return F.map_from_entries(F.sort_array(F.map_entries(c)))


def asset_review_rows(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One request row per asset of single-asset jobs, and the assets that cannot be asked.

    Equal evidence is reduced first; an asset left with several versions is in
    conflict, one without images cannot be reviewed.
    """
    asset = F.get("assets", F.lit(0))
    single = jobs.filter(F.size("assets") == 1)
    versions = single.select(
        asset["asset_id"].alias("sample_id"),
        canonical_json(sorted_map(F.col("review_images"))).alias("images"),
        canonical_json(asset).alias("context"),
    ).distinct()
    per_asset = versions.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("_versions"), F.min("images").alias("images"), F.min("context").alias("context")
    )
    code = F.when(F.col("_versions") > 1, "conflicting_evidence").when(F.col("images") == "{}", "no_images")
    rows = per_asset.filter(code.isNull()).select(
        "sample_id",
        F.from_json("images", "map<string,string>").alias("review_images"),
        F.lit("asset_identity").alias("stage"),
        F.col("context").alias("review_context"),
    )
    return rows, per_asset.select("sample_id", code.alias("code")).filter(F.col("code").isNotNull())


def pair_review_rows(records: DataFrame) -> DataFrame:
    """One request row per rendered record."""
    return records.select(
        "sample_id",
        F.col("paths").alias("review_images"),
        F.lit("rendered_triplet").alias("stage"),
        canonical_json(F.struct("camera_id", "selected_obj_ids")).alias("review_context"),
    )


def with_request_sha(rows: DataFrame) -> DataFrame:
    body = F.struct(
        F.col("review_context"), sorted_map(F.col("review_images")).alias("review_images"), F.col("sample_id"), F.col("stage")
    )
    return rows.withColumn("request_sha256", canonical_sha(body))


def decision_sha(df_decision: Column) -> Column:
    """Hash that binds a decision row; the confidence enters as text."""
    body = F.concat_ws(
        "|",
        "sample_id",
        "request_sha256",
        *[F.coalesce(df_decision[k].cast("string"), F.lit("null")) for k in sorted(DECISION_KEYS)],
        F.col("hard_failure").cast("string"),
        F.coalesce("request_error", F.lit("null")),
    )
    return sha(body)


def reuse_decisions(requests: DataFrame, prior: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split requests into prior decisions that still hold and requests still to make.

    A prior decision holds when it answers the same request, had no request
    error and is bound by its own hash (``self_bound``).
    """
    valid = prior.filter(F.col("request_error").isNull() & is_true(F.col("self_bound")))
    key = ["sample_id", "request_sha256"]
    reused = valid.join(requests.select(*key), key, "left_semi")
    pending = requests.join(valid.select(*key), key, "left_anti")
    return reused, pending


def score(pending: DataFrame, scorer: Callable[[dict[str, Any]], dict[str, Any]], in_flight: int = 8) -> DataFrame:
    """Run a user's scorer over request rows, a batch at a time, and bind its decisions.

    Each task has up to ``in_flight`` calls open at once, as a scorer mostly waits for
    an answer; it must bear calls from several threads, or ``in_flight`` be 1.
    A scorer that raises, or answers with other keys than the schema's, gives
    an ``unverifiable`` decision and the error text.
    """
    columns = pending.columns

    def ask(values: tuple) -> tuple[str | None, str | None]:
        try:
            return json.dumps(scorer(dict(zip(columns, values)))), None
        except Exception as error:  # user code: any failure is data here
            return None, f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                answers = list(pool.map(ask, batch.itertuples(index=False, name=None)))
                yield pd.DataFrame(
                    {
                        "sample_id": batch["sample_id"],
                        "request_sha256": batch["request_sha256"],
                        "raw": pd.Series([a for a, _ in answers], index=batch.index, dtype=object),
                        "request_error": pd.Series([e for _, e in answers], index=batch.index, dtype=object),
                    }
                )

    scored = pending.mapInPandas(run, "sample_id STRING, request_sha256 STRING, raw STRING, request_error STRING")
    conforms = decision_conforms(F.col("raw"))
    unverifiable = F.from_json(
        F.lit(
            json.dumps(
                {k: False for k in (*MUST_HOLD, *MUST_NOT_HOLD)}
                | {"decision": "unverifiable", "confidence": 0.0, "reason": "review request failed"}
            )
        ),
        DECISION_SCHEMA,
    )
    return (
        scored.select(
            "sample_id",
            "request_sha256",
            F.when(conforms, F.from_json("raw", DECISION_SCHEMA)).otherwise(unverifiable).alias("decision"),
            F.coalesce("request_error", F.when(~conforms, F.lit("response keys differ from the schema"))).alias("request_error"),
        )
        .withColumn("hard_failure", hard_failure(F.col("decision")))
        .withColumn("decision_sha256", decision_sha(F.col("decision")))
    )


def review_summary(decisions: DataFrame) -> DataFrame:
    """Counts over all decisions; ``reused`` marks those taken from an earlier round."""
    hard = F.coalesce("hard_failure", F.lit(False))
    return decisions.agg(
        F.count(F.lit(1)).alias("reviewed_count"),
        F.count_if(is_true(F.col("reused"))).alias("reused_count"),
        F.count_if(not_true(F.col("reused"))).alias("requested_count"),
        F.count_if(~hard).alias("accepted_count"),
        F.count_if(hard).alias("candidate_count"),
        F.count_if(F.col("request_error").isNotNull()).alias("request_error_count"),
    )


def request_violations(requests: DataFrame) -> DataFrame:
    """Requests with an empty or repeated identity, or without images."""
    counted = requests.groupBy(text(F.col("sample_id")).alias("sample_id")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.size("review_images")).alias("_images")
    )
    code = (
        F.when(blank(F.col("sample_id")), "empty_identity")
        .when(F.col("_n") > 1, "duplicate_identity")
        .when(F.col("_images") < 1, "no_images")
    )
    return counted.select("sample_id", code.alias("code")).filter(F.col("code").isNotNull())


def request_id(df: DataFrame) -> Column:
    return first_text(*[F.col(c) for c in ("sample_id", "asset_id") if c in df.columns])
