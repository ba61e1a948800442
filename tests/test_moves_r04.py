"""What the audits and the publication of a release move and store."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from conftest import SF
from test_ring_audit_moves import joined_columns

from __spark_entry__ import queries
from pairgrid.functions.semantics import ROLES, packed, unpacked
from pairgrid.operators import audit, release
from pairgrid.session import scratch_path
from pairgrid.sources import writers


def test_packed_texts_come_back(spark):
    df = spark.createDataFrame([("ab" * 32,), ("AB" * 32,), ("",), ("short ä",), (None,), ("x" * 64,)], "t string")
    assert all(r.t == r.u for r in df.select("t", unpacked(packed(F.col("t"))).alias("u")).collect())


def test_a_release_is_stored_once_before_it_is_published(spark, monkeypatch):
    kept, own = [], release.staged
    monkeypatch.setattr(release, "staged", lambda df, name: kept.append(df.schema) or own(df, name))
    row = "sample_id string, gt string, input string, target string, note string"
    one = spark.createDataFrame([("a", "A" * 64, "b" * 64, "é" * 64, "n1"), ("c", "a" * 64, "b" * 64, "é" * 64, "n2")], row)
    two = spark.createDataFrame([("a", "A" * 64, "b" * 64, "é" * 64, "n3")], row)
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("sha256")) for r in ROLES])).alias("f")
    files = one.select(F.lit("r1").alias("source_root"), F.concat("sample_id", F.lit(".png")).alias("name"), each).select("source_root", "name", "f.*")
    dest = scratch_path(spark, "release")
    _, left = release.publish_release([(one, "r1"), (two, "r2")], files, dest, ["batch", "sample_id"])
    assert len(kept) == 1 and all(kept[0][r].dataType == T.BinaryType() for r in ROLES)
    told = {r.sample_id: (r.gt, r.input, r.target, r.note, r.source_root) for r in writers.read_published(spark, dest).collect()}
    assert told == {"a": ("A" * 64, "b" * 64, "é" * 64, "n1", "r1"), "c": ("a" * 64, "b" * 64, "é" * 64, "n2", "r1")}
    assert [tuple(r) for r in left.select("sample_id", "batch", "canonical").collect()] == [("a", 1, "a")]


def test_roles_move_as_a_few_bytes_and_are_told_apart(spark):
    h = "a" * 64
    records = spark.createDataFrame(
        [("s", (h, h, "short")), ("t", (h, None, h)), ("u", (h, h, h)), ("v", (h, h, h)), (None, (h, h, h))],
        "sample_id string, content_sha256 struct<gt: string, input: string, target: string>",
    )
    stored = [("gt", "s.png", h), ("gt", "s.png", "A" * 64), ("input", "s.png", None), ("gt", "t.png", h[:-1] + "b"), ("target", "t.png", h)]
    stored += [(r, "u.png", h) for r in ROLES] + [("odd", "u.png", h), (None, "u.png", h)] + [(r, "v.png", h) for r in ("input", "gt", "target")]
    files = spark.createDataFrame(stored, "role string, name string, sha256 string")
    sets, rows = audit.content_sets(records), audit.content_rows(records)
    expected = {
        ("s", "gt", "hash_mismatch"), ("s", "input", "missing_file"), ("s", "target", "invalid_content_hash"), ("t", "gt", "hash_mismatch"),
        ("t", "input", "invalid_content_hash"), *[(None, r, "missing_file") for r in ROLES],
    }
    for given in (sets, rows):
        assert sorted(map(tuple, audit.content_errors(given, files).collect()), key=repr) == sorted(expected, key=repr)
        assert audit.looked_up(given, files).count() == 16
    strange = rows.withColumns({"role": F.when(F.col("role") == "gt", "odd").otherwise(F.col("role")), "name": F.lit("u.png")})
    told = audit.looked_up(strange.filter("sample_id = 'v'"), files).filter("role = 'odd'").first()
    assert (told.sample_id, told.same) == ("v", True)


def test_no_hash_as_text_is_joined(spark):
    moved = joined_columns(queries()["j13_content_errors"](spark, SF))
    assert {"wanted", "stored"} <= moved and not moved & {"expected", "sha256", "sample_id", "role"}


def test_records_and_reviews_stay_where_they_lie(spark):
    from pairgrid.plans import audit_queries

    records, files = audit_queries._release(spark, SF)
    moved = joined_columns(audit.record_errors(records, audit_queries._reviews(records)))
    assert moved and not moved & {"asset_layers", "_review", "decision", "content_sha256", "record_sha256"}
    assert not joined_columns(files)
