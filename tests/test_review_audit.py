import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from pairgrid.operators import audit, review

GOOD = {
    "decision": "accept", "same_identity": True, "broken_or_doubled_asset": False, "orientation_valid": True, "scale_valid": True,
    "grounding_valid": True, "severe_occlusion_error": False, "confidence": 0.1, "reason": "",
}


def requests(spark):
    rows = [(f"s{i}", {"source": "a.png"}, "asset_identity", "{}") for i in range(8)]
    return review.with_request_sha(
        spark.createDataFrame(rows, "sample_id STRING, review_images MAP<STRING,STRING>, stage STRING, review_context STRING")
    )


def test_a_second_round_asks_nothing(spark):
    asked = requests(spark)
    first = review.score(asked, lambda row: GOOD).cache()
    assert first.filter("hard_failure").count() == 0
    bound = first.withColumn("self_bound", review.decision_sha(F.col("decision")) == F.col("decision_sha256"))
    reused, pending = review.reuse_decisions(asked, bound)
    assert (reused.count(), pending.count()) == (8, 0)
    changed = asked.withColumn("request_sha256", F.sha2("request_sha256", 256))
    assert review.reuse_decisions(changed, bound)[1].count() == 8
    forged = bound.withColumn("self_bound", F.lit(None).cast("boolean"))
    assert review.reuse_decisions(asked, forged)[1].count() == 8


def test_scorer_failures_are_decisions(spark):
    def scorer(row):
        if row["sample_id"] == "s0":
            raise OSError("down")
        if row["sample_id"] == "s1":
            return GOOD | {"more": 1}
        if row["sample_id"] == "s2":
            return GOOD | {"severe_occlusion_error": True}
        return GOOD

    got = {r.sample_id: r for r in review.score(requests(spark), scorer).collect()}
    assert got["s0"].decision.decision == "unverifiable" and got["s0"].request_error == "OSError: down"
    assert got["s1"].decision.decision == "unverifiable" and got["s1"].hard_failure
    assert got["s2"].hard_failure and got["s2"].request_error is None
    assert not got["s3"].hard_failure


def test_two_calls_are_open_at_once(spark):
    import threading

    def meeting(row):
        # Breaks unless a second call arrives while the first waits.
        import sys

        gate = sys.modules.setdefault("_review_gate", threading.Barrier(2))
        gate.wait(timeout=20)
        return GOOD

    scored = review.score(requests(spark).coalesce(1), meeting, in_flight=2)
    assert scored.filter("hard_failure").count() == 0


def test_windows_stay_together_and_large_ones_are_cut(spark):
    jobs = spark.range(1000).select(
        F.format_string("j%04d", "id").alias("sample_id"), F.lit("s").alias("scene_name"),
        F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 30).cast("string"))).alias("window_id"),
    )

    def worker(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"window_id": rows["window_id"], "distinct": rows["window_id"].nunique(), "size": len(rows)})

    whole = audit.run_batches(jobs, worker, "window_id STRING, distinct LONG, size LONG").toPandas()
    assert len(whole) == 1000 and (whole["distinct"] == 1).all() and (whole.loc[whole.window_id == "hot", "size"] == 700).all()
    out = audit.run_batches(jobs, worker, "window_id STRING, distinct LONG, size LONG", 100).toPandas()
    assert len(out) == 1000 and (out["distinct"] == 1).all()
    assert out.loc[out.window_id == "hot", "size"].max() < 250
    assert (out.loc[out.window_id != "hot", "size"] == 10).all()


def test_windows_across_arrow_batches_keep_their_own_types(spark):
    """A null in one window changes no number of another; a window over several batches is one frame."""
    jobs = spark.range(3000).select(
        F.format_string("j%05d", F.col("id") * 7919 % 3000).alias("sample_id"), F.lit("s").alias("scene_name"),
        F.when(F.col("id") < 1500, "hot").when(F.col("id") % 40 > 0, F.concat(F.lit("w"), (F.col("id") % 40).cast("string"))).alias("window_id"),
        F.when(F.col("id") % 40 != 7, F.lit(2**60 + 1) + F.col("id")).alias("big"),
    )

    def worker(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows["sample_id"].is_monotonic_increasing
        total = None if rows["big"].isnull().any() else sum(int(x) % 2**60 for x in rows["big"])
        names = list(rows.columns)
        return pd.DataFrame({"window_id": rows["window_id"].iloc[:1], "size": len(rows), "ordered": ordered, "total": total, "columns": len(names)})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = audit.run_batches(jobs, worker, "window_id STRING, size LONG, ordered BOOLEAN, total LONG, columns LONG")
        assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
        found = {r.window_id: (r.size, r.ordered, r.total, r.columns) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    sums = jobs.groupBy("window_id").agg(F.count("*").alias("n"), F.sum(F.col("big") - 2**60).alias("t"), F.count_if(F.col("big").isNull()).alias("none"))
    assert found == {r.window_id: (r.n, True, None if r.none else r.t, 4) for r in sums.collect()}


def test_a_window_is_streamed_whole_and_in_order(spark):
    jobs = spark.range(5000).select(
        F.format_string("j%05d", F.col("id") * 7919 % 5000).alias("sample_id"), F.lit("s").alias("scene_name"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 30).cast("string"))).alias("window_id"),
    )

    def worker(batches):
        seen, most, ordered, window = 0, 0, True, None
        last = ""
        for batch in batches:
            ids = batch.column("sample_id").to_pylist()
            ordered = ordered and ids == sorted(ids) and last <= ids[0]
            last, window = ids[-1], batch.column("window_id")[0].as_py()
            seen, most = seen + len(ids), max(most, len(ids))
        yield pa.RecordBatch.from_pylist([{"window_id": window, "seen": seen, "most": most, "ordered": ordered}])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r.window_id: r for r in audit.run_windows(jobs, worker, "window_id STRING, seen LONG, most LONG, ordered BOOLEAN").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    wanted = {r.window_id: r["count"] for r in jobs.groupBy("window_id").count().collect()}
    assert {k: r.seen for k, r in got.items()} == wanted
    assert all(r.ordered for r in got.values()) and max(r.most for r in got.values()) <= 100


def test_closeness_and_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.00001, 2.0]), ([1.0], [1.1]), ([1.0], [1.0, 2.0])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    assert [r[0] for r in df.select(audit.close_to(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_reconcile_with_repeats(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("b",)], "name STRING")
    observed = spark.createDataFrame([("b",), ("c",), ("c",)], "name STRING")
    got = {(r.name, r.side) for r in audit.reconcile(expected, observed, ["name"]).collect()}
    assert got == {("a", "missing"), ("c", "extra")}
