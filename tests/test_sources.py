import hashlib
import json
import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairgrid.functions import hashing
from pairgrid.functions import semantics as sem
from pairgrid.operators import pixels, planning
from pairgrid.sources import readers, writers


def png(array, colour=2):
    height, width = array.shape[:2]

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    rows = b"".join(b"\0" + row.tobytes() for row in array)
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_jsonl_order_blank_lines_and_refusals(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text("".join(json.dumps({"a": i}) + "\n" + ("  \n" if i % 3 == 0 else "") for i in range(500)))
    rows = readers.read_jsonl(spark, str(path), "a INT", keep_raw=True)
    assert [r.a for r in rows.orderBy("ord").collect()] == list(range(500))
    assert rows.filter("a = 7").first().raw_json == '{"a": 7}'
    path.write_text('{"a": 1}\n[{"a": 2}]\n')
    with pytest.raises(Exception, match="expected an object"):
        readers.read_jsonl(spark, str(path), "a INT").collect()
    assert readers.read_jsonl(spark, str(path), "a INT", strict=False).count() == 1
    assert readers.manifest_violations(spark, str(path)).count() == 1


def test_document_manifest(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"assets": [{"obj_id": "b"}, {"obj_id": "a"}], "other": 1}, indent=2))
    rows = readers.read_manifest(spark, str(tmp_path / "d.json"), "assets", "obj_id STRING")
    assert [r.obj_id for r in rows.orderBy("pos").collect()] == ["b", "a"]


@pytest.mark.parametrize("shape", ["plain", "outputs", "flat"])
def test_handoff_shapes(spark, tmp_path, shape):
    body = b'{"assets": []}'
    (tmp_path / "exact.json").write_bytes(body)
    sha = hashlib.sha256(body).hexdigest()
    doc = {
        "plain": {"manifest": "exact.json", "manifest_sha256": sha},
        "outputs": {"outputs": {"exact_asset_manifest": {"path": "exact.json", "sha256": sha}}},
        "flat": {"exact_asset_manifest": "exact.json", "exact_asset_manifest_sha256": sha},
    }[shape]
    post = tmp_path / "post.json"
    post.write_text(json.dumps({"status": "complete", "excluded_asset_ids": ["x"], **doc}))
    found = readers.resolve_handoff(spark, str(post))
    assert found.manifest.endswith("exact.json") and found.excluded_ids == ("x",)
    (tmp_path / "exact.json").write_bytes(body + b" ")
    with pytest.raises(ValueError, match="hash mismatch"):
        readers.resolve_handoff(spark, str(post))
    post.write_text(json.dumps({"status": "running", **doc}))
    with pytest.raises(ValueError, match="not complete"):
        readers.resolve_handoff(spark, str(post))


def test_images_headers_and_content(spark, tmp_path):
    good = np.zeros((288, 512, 3), np.uint8)
    good[10:20, 30:40] = (1, 2, 3)
    files = {
        "good.png": png(good),
        "cut.png": png(good)[:200],
        "small.png": png(np.zeros((8, 8, 3), np.uint8)),
        "grey.png": png(np.zeros((288, 512), np.uint8), 0),
        "text.png": b"not an image",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    images = readers.read_images(spark, str(tmp_path))
    assert {r.name: r.codes for r in readers.image_codes(images).collect()} == {
        "cut.png": ["undecodable"], "text.png": ["undecodable"], "small.png": ["wrong_dimensions"], "grey.png": ["not_rgb"],
    }
    decoded = {sem_name(r.path): r for r in pixels.decode_pixels(images).collect()}
    assert decoded["good.png"].pixels == good.tobytes()
    assert len(decoded["grey.png"].pixels) == 288 * 512
    content = {r.name: r for r in readers.read_content(spark, str(tmp_path)).collect()}
    assert all(content[n].sha256 == hashlib.sha256(d).hexdigest() and content[n].length == len(d) for n, d in files.items())
    raw = spark.createDataFrame([(n, bytearray(d)) for n, d in files.items()], "name STRING, content BINARY")
    assert {r.name: r.codes for r in readers.png_violations(raw).collect()} == {
        "small.png": ["wrong_dimensions"], "grey.png": ["not_rgb"], "text.png": ["not_png"],
    }
    members = {(r.folder, r.name, r.stem) for r in readers.list_members(spark, str(tmp_path)).collect()}
    assert (tmp_path.name, "good.png", "good") in members and len(members) == 5
    wanted = spark.createDataFrame(
        [("s", "target", f"file:{tmp_path}/good.png", content["good.png"].sha256), ("s", "alpha", f"file:{tmp_path}/good.png", "0" * 64), ("s", "gt", "nowhere", "0" * 64)],
        "owner STRING, slot STRING, path STRING, sha256 STRING",
    )
    stored = readers.read_content(spark, str(tmp_path)).select("name", "sha256")
    table = (
        pixels.decode_pixels(images).withColumn("name", sem.base_name(F.col("path"))).join(stored, "name")
        .withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    )
    got = {r.slot: r.code for r in pixels.attach_images(wanted, table).collect()}
    assert got == {"target": None, "alpha": "source_hash_mismatch", "gt": "missing_file"}


def sem_name(path):
    return path.rsplit("/", 1)[-1]


def test_id_list_and_manifest_round_trip(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("  a \n\n b\n   \n")
    assert sorted(r.sample_id for r in readers.read_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b"]
    df = spark.createDataFrame([("x", None, [1, 2])], "b STRING, a STRING, c ARRAY<INT>")
    writers.write_manifest(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '{"a":null,"b":"x","c":[1,2]}'


TEXTS = ["plain", 'quote " and \\ slash', "tab\tnew\nline", "é ü 漢字 😀", "\u0001\u000b\u001f\u007f", "literal \\u000B", "</b>", ""]


def test_canonical_hash_equals_json_dumps(spark):
    rows = [(t, i, [t, None]) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "t STRING, n INT, l ARRAY<STRING>")
    got = {r.n: r.h for r in df.select("n", hashing.object_sha(df, {"t": F.col("t"), "n": F.col("n"), "l": F.col("l")}).alias("h")).collect()}
    for t, n, items in rows:
        body = json.dumps({"t": t, "n": n, "l": items}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        assert got[n] == hashlib.sha256(body.encode()).hexdigest()
    with pytest.raises(TypeError):
        hashing.object_sha(spark.range(1), {"x": F.lit(0.1).cast("decimal(3,1)")})


def test_float_text_equals_repr(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, 0.1, 1e-5, 1e-4, 1e15, 1e16, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1e22, 1e23, 2e23]
    values += [5.684341886080802e-14, 9.999999999999999e22, -1.5e-7, 9007199254740993.0, -1.3344444525294854e18, 3.0617315596860195e25]
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(5000)]
    values += [rng.random() * 10 ** rng.randint(-8, 33) for _ in range(3000)] + [2.0**k for k in range(-1074, 1000, 7)] + [math.nan, math.inf, -math.inf]
    df = spark.createDataFrame(list(enumerate(values)), "i LONG, v DOUBLE")
    got = {r.i: r.t for r in df.select("i", hashing.float_text(F.col("v")).alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [repr(v) if math.isfinite(v) else None for v in values]


def test_nested_values_hash_like_json_dumps(spark):
    value = {"b": {"z": [1.5, None, 1e-7], "a": None, "é\"": True}, "m": {"y": 0.1, "x": 2.0}, "l": [[1], []], "n": 12345678901}
    kind = "b STRUCT<z: ARRAY<DOUBLE>, a: STRING, `é\"`: BOOLEAN>, m MAP<STRING, DOUBLE>, l ARRAY<ARRAY<INT>>, n LONG"
    body = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    df = spark.createDataFrame([value], kind)
    whole = F.struct(*[F.col(c) for c in df.columns])
    assert df.select(hashing.canonical_text(whole, hashing.kind_of(df, whole))).first()[0] == body
    own = df.select(hashing.signed(df, whole.withField("decision_sha256", F.lit(""))).alias("s"))
    kind = own.schema["s"].dataType
    bound = lambda c: own.select(hashing.bound_to_itself(c, kind)).first()[0]
    assert own.first().s.decision_sha256 == hashlib.sha256(body.encode()).hexdigest()
    assert bound(F.col("s")) and not bound(F.col("s").withField("n", F.lit(1).cast("long"))) and not bound(F.col("s").withField("decision_sha256", F.lit("x")))
    broken = df.withColumn("m", F.create_map(F.lit("x"), F.lit(math.nan)))
    assert broken.select(hashing.canonical_text(whole, hashing.kind_of(broken, whole))).first()[0] is None


def test_source_line_hashes_keep_float_text(spark):
    value = {"b": 1e-05, "a": [0.1, 1.0, -0.0], "t": "é"}
    own = hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    lines = [json.dumps(value | {"h": own}), json.dumps(value | {"h": own, "c": 1}), json.dumps(value), "[1]", "{bad", '{"x": NaN}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i INT, s STRING")
    got = [r[1] for r in df.select("i", hashing.self_hash_ok(F.col("s"), "h")).orderBy("i").collect()]
    assert got == [True, False, False, False, False, False]


def test_digest_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    one = hashing.manifest_digest(df, ["k"]).first()
    assert one == hashing.manifest_digest(df.orderBy(F.desc("k")).repartition(7), ["k"]).first()
    assert one != hashing.manifest_digest(df.unionByName(df.filter("k = '3'")), ["k"]).first()


def test_value_semantics(spark):
    df = spark.createDataFrame([(None, "", "x"), ("a", "b", None)], "a STRING, b STRING, c STRING")
    assert [r[0] for r in df.select(sem.first_text(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["x", "a"]
    n = spark.createDataFrame([(0.0,), (None,), (2.5,), (float("nan"),)], "v DOUBLE")
    got = n.select(sem.nonzero_or(F.col("v"), float("inf")), sem.finite(F.col("v")), sem.at_least(F.col("v"), F.lit(1.0))).collect()
    assert [tuple(r)[:2] for r in got[:3]] == [(float("inf"), True), (float("inf"), False), (2.5, True)]
    assert got[3][1] is False and got[3][2] is False
    half = spark.createDataFrame([(0.5 / 255,), (1.5 / 255,), (-1.0,), (2.0,)], "v DOUBLE")
    assert [r[0] for r in half.select(sem.to_byte(F.col("v"))).collect()] == [0, 2, 0, 255]
    wide = spark.createDataFrame([(7,), (1234,)], "v INT")
    assert [r[0] for r in wide.select(sem.frame_name(F.col("v"))).collect()] == ["f007", "f1234"]
    assert spark.range(1).select(sem.utc_stamp()).first()[0].endswith("Z")


def test_both_asset_shapes(spark):
    nested = spark.createDataFrame(
        [("u", "o", "t", "car", "a/b.ply", [1, 2, 3], ("h" * 64, "+X"))],
        "global_uid STRING, obj_id STRING, instance_token STRING, category STRING, asset_path STRING, size_xyz ARRAY<INT>, canonical STRUCT<canonical_asset_sha256: STRING, front_axis: STRING>",
    )
    one = planning.normalize_assets(nested, "/root/x").first()
    assert (one.asset_id, one.ply_path, one.ply_sha256, one.dimensions_m, one.forward_axis) == ("u", "/root/x/a/b.ply", "h" * 64, [1.0, 2.0, 3.0], "+X")
    assert planning.asset_violations(planning.normalize_assets(nested)).count() == 0


def test_a_stamp_beyond_year_9999_has_no_sign(spark):
    at = spark.createDataFrame([(5999999 * 86413,), (86413,)], "s LONG").select(F.timestamp_seconds("s").alias("at"))
    assert [r[0] for r in at.select(sem.utc_stamp(F.col("at"))).collect()] == ["183991129T183947Z", "19700102T000013Z"]
