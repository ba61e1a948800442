"""Plans that keep the work of large tables in proportion."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import SF
from pairgrid.functions.hashing import canonical_text, kind_of, manifest_digest
from pairgrid.functions.semantics import ROLES
from pairgrid.operators import audit, planning
from pairgrid.sources import writers


def _plan(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_evidence_is_read_without_hashing_the_receipt(spark):
    assert "to_json" not in _plan(spark, "p16_official_evidence") and "sha2" not in _plan(spark, "p16_official_evidence").replace("sha2(obj_id", "")


def test_a_long_number_beside_long_texts_and_marks(spark):
    texts = ["x" * 50000, "\x01abc", "abc\x02", 'a"\x01b\x02', "1.2345678901234567E8", 'q"\\']
    rows = [(t, v) for t in texts for v in (1 / 7, 0.1 + 0.2, 1e-7, 2.5, -1e22)]
    df = spark.createDataFrame(rows, "s STRING, v DOUBLE")
    body = F.struct("s", "v")
    got = [r[0] for r in df.select(canonical_text(body, kind_of(df, body))).collect()]
    assert got == [json.dumps({"s": s, "v": v}, ensure_ascii=False, separators=(",", ":")) for s, v in rows]


def test_a_strict_plan_binds_observations_once(spark, monkeypatch):
    calls, bind = [], planning.bind_assets
    monkeypatch.setattr(planning, "bind_assets", lambda *given: calls.append(1) or bind(*given))
    queries()["g2_plan"](spark, SF)
    assert len(calls) == 1


def test_a_written_version_is_summed_up_once(spark, monkeypatch, tmp_path):
    def refused(*_):
        raise AssertionError("the version is read again")

    monkeypatch.setattr(writers, "manifest_digest", refused, raising=False)
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    writers.publish_table(df, str(tmp_path / "t"), ["id", "v"])
    told = writers.published_versions(spark, str(tmp_path / "t")).first()
    assert (told.row_count, told.digest) == tuple(manifest_digest(df, ["id", "v"]).first())


def test_usual_values_are_reconciled_in_one_row(spark):
    kind = "role STRING, name STRING"
    left = spark.createDataFrame([("gt", "a"), ("gt", "a"), ("input", "a"), ("odd", "a"), (None, "b"), ("gt", None), ("target", "c")], kind)
    right = spark.createDataFrame([("gt", "a"), ("target", "a"), ("odd", "b"), (None, "b"), (None, None), ("target", "c")], kind)
    plain, packed = (sorted(map(tuple, audit.reconcile(left, right, ["role", "name"], few).collect()), key=repr) for few in (None, ("role", ROLES)))
    assert plain == packed and len(packed) == 6
    text = _plan(spark, "j12_reconcile")
    assert "bit_or" in text and "_side3" in text
