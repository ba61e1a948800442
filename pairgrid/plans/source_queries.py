"""Queries over sources, sinks, hashes and formatted ids.

Files are written from the derived tables into shared scratch space and read
back, so the work grows with the data.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

from pairgrid.functions import hashing, semantics as sem
from pairgrid.operators import release
from pairgrid.operators.pixels import decode_png_column, pack
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.pixel_queries import _BYTE, SIDE
from pairgrid.plans.registry import query
from pairgrid.session import scratch_path, staged
from pairgrid.sources import readers, writers

_ROW = "sample_id STRING, camera_id STRING, frame_index INT, assets ARRAY<STRING>"


def _manifest(spark, sf) -> str:
    """A JSONL manifest of the records, with blank lines, and a list for some rows."""
    line = F.to_json(F.struct("sample_id", "camera_id", "frame_index", "assets"))
    rows = fx.records(spark, sf).select(
        F.explode(
            F.when(F.col("q") == 50, F.array(line, F.lit("  ")))
            .when(F.col("q") == 49, F.array(F.concat(F.lit("["), line, F.lit("]"))))
            .otherwise(F.array(line))
        ).alias("value")
    )
    path = scratch_path(spark, "manifest")
    rows.write.text(path)
    return path


@query("s1_scan_manifest", with_tables(("records",), """
  SELECT sample_id, camera_id, frame_index, array_to_string(assets, ',') AS assets FROM records WHERE q <> 49"""))
def _(spark, sf):
    rows = readers.read_jsonl(spark, _manifest(spark, sf), _ROW, strict=False)
    return rows.drop("ord").withColumn("assets", F.concat_ws(",", "assets"))


@query("s1_manifest_violations", with_tables(("records",), """
  SELECT count(*) AS bad_lines FROM records WHERE q = 49"""))
def _(spark, sf):
    return readers.manifest_violations(spark, _manifest(spark, sf)).agg(F.count(F.lit(1)).alias("bad_lines"))


@query("s2_scan_documents", with_tables(("obs",), """
  SELECT DISTINCT scene_name, obj_id, (['car','truck','bus','van'])[obj_no % 4 + 1] AS category FROM obs"""))
def _(spark, sf):
    jobs = fx.visibility_jobs(spark, sf).select("scene_name", F.struct("scene_name", "obj_id", "category").alias("job"))
    path = scratch_path(spark, "documents")
    # One document per scene; a scene has six objects.
    jobs.groupBy("scene_name").agg(F.collect_list("job").alias("jobs")).select("jobs").write.json(path)
    return readers.read_manifest(
        spark, path, "jobs", "scene_name STRING, obj_id STRING, category STRING", one_per_line=True
    ).drop("pos")


def _in_folders(name: Column) -> Column:
    """Names of many files spread over 256 folders, so that they are listed in parallel."""
    return F.concat(F.substring(F.md5(name.cast("binary")), 1, 2), F.lit("/"), name)


def _scene_files(spark, sf, name: Column) -> str:
    """One small text file per scene under the given name."""
    path = scratch_path(spark, "scenes")
    content = F.concat(F.concat_ws("|", F.count(F.lit(1)), F.sum("pk"), F.max("q")), F.lit("\n"))
    scenes = fx.obs(spark, sf).groupBy("scene_name").agg(content.alias("content"))
    writers.write_files(scenes.select(name.alias("name"), "content"), path)
    return path


define("scene_files", ("obs",), """
  SELECT scene_name, count(*) || '|' || sum(pk) || '|' || max(q) || chr(10) AS content FROM obs GROUP BY 1""")


@query("s4_file_hashes", with_tables(("scene_files",), """
  SELECT scene_name, sha256(content) AS sha256, CAST(length(content) AS BIGINT) AS length FROM scene_files"""))
def _(spark, sf):
    files = readers.read_content(spark, _scene_files(spark, sf, _in_folders(F.concat("scene_name", F.lit(".txt")))), below=True)
    return files.select(sem.stem(F.col("path")).alias("scene_name"), "sha256", "length")


@query("s7_list_members", with_tables(("scene_files",), """
  SELECT 'scene_name=' || scene_name AS folder, 1::BIGINT AS files FROM scene_files"""))
def _(spark, sf):
    members = readers.list_members(spark, _scene_files(spark, sf, F.format_string("scene_name=%s/members.txt", "scene_name"))).filter(F.col("name").endswith(".txt"))
    return members.groupBy("folder").agg(F.count(F.lit(1)).alias("files"))


@query("s6_read_ids", with_tables(("records",), "SELECT sample_id FROM records WHERE q = 50"))
def _(spark, sf):
    path = scratch_path(spark, "ids")
    listed = fx.records(spark, sf).select(
        F.explode(F.when(F.col("q") == 50, F.array(F.concat(F.lit("  "), "sample_id"), F.lit(" "))).otherwise(F.array(F.lit("")))).alias("v")
    )
    listed.write.text(path)
    return readers.read_ids(spark, path)


@query("s8_write_manifest", with_tables(("records",), """
  SELECT '{"camera_id":"' || camera_id || '","frame_index":' || frame_index || ',"n":' || CASE WHEN d > 0 THEN CAST(n AS VARCHAR) ELSE 'null' END
         || ',"sample_id":"' || sample_id || '"}' AS value FROM records"""))
def _(spark, sf):
    path = scratch_path(spark, "written")
    n = F.when(F.col("d") > 0, F.col("n"))
    writers.write_manifest(fx.records(spark, sf).select("sample_id", n.alias("n"), "frame_index", "camera_id"), path)
    return spark.read.text(path)


@query("s9_write_summary", with_tables(("records",), """
  SELECT '{"record_count":' || count(*) || ',"scene_count":' || count(DISTINCT scene_name) || '}' AS value FROM records"""))
def _(spark, sf):
    path = scratch_path(spark, "summary")
    scenes = fx.records(spark, sf).groupBy("scene_name").agg(F.count(F.lit(1)).alias("n"))
    writers.write_summary(scenes.agg(F.count(F.lit(1)).alias("scene_count"), F.sum("n").alias("record_count")), path)
    return spark.read.text(path)


@query("f14_utc_stamp", """
  SELECT event_id, strftime(make_timestamp(event_id * 86413000000), '%Y%m%dT%H%M%SZ') AS stamp FROM events""")
def _(spark, sf):
    instant = F.timestamp_seconds(F.col("event_id") * 86413)
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", sem.utc_stamp(instant).alias("stamp"))


@query("s10_publish", with_tables(("records",), "SELECT sample_id, gt, input, target FROM records WHERE q < 50"))
def _(spark, sf):
    dest = scratch_path(spark, "published")
    rows = staged(fx.records(spark, sf).select("sample_id", "gt", "input", "target", "q"), "records")
    writers.publish_table(rows.drop("q"), dest, ["sample_id", *sem.ROLES])
    writers.publish_table(rows.filter("q < 50").drop("q"), dest, ["sample_id", *sem.ROLES], replace=True)
    return writers.read_published(spark, dest)


@query("s11_missing_outputs", with_tables(("records", "files"), """
  SELECT sample_id FROM records WHERE NOT (d > 0 OR q > 10)"""))
def _(spark, sf):
    found = fx.files(spark, sf).select(sem.stem(F.col("name")).alias("sample_id"))
    return writers.missing_outputs(fx.records(spark, sf), found, ["sample_id"])


@query("g9_publish_release", with_tables(("batches",), """
  SELECT count(*) AS input_record_count, count(DISTINCT gt || input || target) AS triplet_count,
         count(DISTINCT gt || input || target) * 3 AS image_count,
         count(*) - count(DISTINCT gt || input || target) AS duplicate_exclusion_count FROM batches WHERE batch < 2"""))
def _(spark, sf):
    r = fx.records(spark, sf).select("sample_id", "camera_id", "gt", "input", "target")
    first, second = r.filter("camera_id <= '3'"), r.filter("camera_id >= '2'")
    parts = [(first.drop("camera_id"), "root-a"), (second.drop("camera_id"), "root-b")]
    stored = [
        df.select(
            F.lit(root).alias("source_root"),
            F.concat("sample_id", F.lit(".png")).alias("name"),
            F.explode(F.array(*[F.struct(F.lit(x).alias("role"), F.col(x).alias("sha256")) for x in sem.ROLES])).alias("f"),
        ).select("source_root", "f.role", "name", "f.sha256")
        for df, root in parts
    ]
    summary, _ = release.publish_release(parts, stored[0].unionByName(stored[1]), scratch_path(spark, "release"), ("batch", "sample_id"))
    return summary


def _png(grey: bytes, no: int) -> bytes:
    """A small PNG whose kind follows its number: sound, grey, too wide, or not a PNG."""
    kind = no % 4
    width = SIDE * 2 if kind == 2 else SIDE
    rows = [grey[i : i + SIDE] for i in range(0, len(grey), SIDE)]
    if kind != 1:
        rows = [bytes(b for p in row for b in (p, p, p)) for row in rows]
    if kind == 2:
        rows = [row + row for row in rows]

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    head = struct.pack(">IIBBBBB", width, SIDE, 8, 0 if kind == 1 else 2, 0, 0, 0)
    body = chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + r for r in rows))) + chunk(b"IEND", b"")
    return body if kind == 3 else b"\x89PNG\r\n\x1a\n" + body


def _png_files(spark, sf):
    """PNG bytes of every tile, in a column."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            content = [_png(g, int(s[5:]) * 3 + int(o)) for s, o, g in zip(b["sample_id"], b["ord"], b["image"])]
            yield pd.DataFrame({"sample_id": b["sample_id"], "ord": b["ord"], "content": content})

    tiles = fx.tiles(spark, sf).withColumn("byte", sem.to_byte(F.col("alpha")))
    return pack(tiles, ["sample_id", "ord"], "byte").mapInPandas(encode, "sample_id STRING, ord INT, content BINARY")


@query("p23_png_violations", with_tables(("tiles",), """
  SELECT * FROM (SELECT DISTINCT sample_id, ord, CASE (CAST(substr(sample_id, 6) AS BIGINT) * 3 + ord) % 4
    WHEN 1 THEN 'not_rgb' WHEN 2 THEN 'wrong_dimensions' WHEN 3 THEN 'not_png' END AS codes FROM tiles) WHERE codes IS NOT NULL"""))
def _(spark, sf):
    return readers.png_violations(_png_files(spark, sf), SIDE, SIDE).withColumn("codes", F.concat_ws(",", "codes"))


@query("s5_decoded_png", with_tables(("tiles",), f"""
  SELECT sample_id, ord, CASE kind WHEN 3 THEN NULL WHEN 2 THEN 16 ELSE 8 END AS width, CASE kind WHEN 3 THEN NULL WHEN 1 THEN 1 ELSE 3 END AS channels,
         CASE kind WHEN 3 THEN 'not_png' END AS code,
         CASE WHEN kind <> 3 THEN sha256(unhex(string_agg(CASE WHEN kind = 1 THEN h ELSE repeat(h, 3) END, '' ORDER BY y, k, x))) END AS sha256
  FROM (SELECT sample_id, ord, y, x, printf('%02x', {_BYTE.format('alpha')}) AS h, (CAST(substr(sample_id, 6) AS BIGINT) * 3 + ord) % 4 AS kind FROM tiles)
  JOIN range(2) c(k) ON k = 0 OR kind = 2 GROUP BY sample_id, ord, kind"""))
def _(spark, sf):
    decoded = decode_png_column(_png_files(spark, sf))
    return decoded.select("sample_id", "ord", "width", "channels", "code", F.sha2("pixels", 256).alias("sha256"))


@query("f1_content_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def _(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", hashing.sha(F.col("text")).alias("sha256"))


@query("f2_canonical_hash", """
  SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":' || CAST(to_json(lang) AS VARCHAR) || ',"text":'
    || CAST(to_json(text) AS VARCHAR) || '}') AS sha256 FROM documents""")
def _(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fields = {c: F.col(c) for c in ("text", "doc_id", "lang")}
    return docs.select("doc_id", hashing.object_sha(docs, fields).alias("sha256"))


@query("f3_self_hash", with_tables(("records",), "SELECT sample_id, d > 0 AS bound FROM records"))
def _(spark, sf):
    # The claimed hash is of the line's other fields, unless tampered with.
    r = fx.records(spark, sf)
    body = F.struct("assets", "camera_id", "frame_index", "sample_id")
    claimed = hashing.canonical_sha(body)
    tampered = F.when(F.col("d") > 0, claimed).otherwise(F.sha2(claimed, 256))
    line = F.to_json(F.struct("sample_id", "frame_index", "camera_id", "assets", tampered.alias("record_sha256")))
    return r.select("sample_id", hashing.self_hash_ok(line, "record_sha256").alias("bound"))


@query("f4_ids", with_tables(("obs",), """
  SELECT scene_name, camera_id, obj_id, printf('w%06d', frame_index * 1000003) AS wide, printf('f%03d', frame_index) AS frame,
         substr(sha256(CAST(to_json([obj_id, instance_token]) AS VARCHAR)), 1, 12) AS part FROM obs"""))
def _(spark, sf):
    return fx.obs(spark, sf).select(
        "scene_name", "camera_id", "obj_id",
        sem.window_name(F.col("frame_index") * 1000003).alias("wide"),
        sem.frame_name(F.col("frame_index")).alias("frame"),
        F.substring(hashing.canonical_sha(F.array("obj_id", "instance_token")), 1, 12).alias("part"),
    )


@query("f5_split_key", with_tables(("obs",), """
  SELECT scene_name, obj_id, frame_index, camera_id || ':c9' AS camera_id FROM obs"""))
def _(spark, sf):
    frame, camera = sem.split_view_key(F.col("key"))
    keyed = fx.obs(spark, sf).select("scene_name", "obj_id", F.format_string("%06d:c%s:c9", "frame_index", "camera_id").alias("key"))
    return keyed.select("scene_name", "obj_id", frame.alias("frame_index"), camera.alias("camera_id"))


@query("f6_dimensions", with_tables(("obs",), """
  SELECT scene_name, frame_index, camera_id, obj_id, CASE WHEN q > 5 THEN pk || ',' || q || ',' || sk ELSE '' END AS lwh FROM obs"""))
def _(spark, sf):
    wlh = F.when(F.col("q") > 5, F.array("q", "pk", "sk")).otherwise(F.array("q", "pk"))
    lwh = sem.lwh_from_wlh(wlh.cast("array<double>"))
    return fx.obs(spark, sf).select(
        "scene_name", "frame_index", "camera_id", "obj_id",
        F.concat_ws(",", F.transform(lwh, lambda v: v.cast("bigint").cast("string"))).alias("lwh"),
    )


@query("f7_first_text", with_tables(("obs",), """
  SELECT scene_name, frame_index, camera_id, obj_id, CASE WHEN q > 40 THEN obj_id WHEN q > 30 THEN instance_token ELSE '' END AS chosen FROM obs"""))
def _(spark, sf):
    q = F.col("q")
    chosen = sem.first_text(
        F.when(q > 40, F.col("obj_id")).when(q > 20, F.lit("")), F.when(q > 30, F.col("instance_token")), F.when(q > 10, F.lit(""))
    )
    return fx.obs(spark, sf).select("scene_name", "frame_index", "camera_id", "obj_id", chosen.alias("chosen"))


@query("f12_names", with_tables(("records",), """
  SELECT sample_id || '.png' AS name, sample_id AS stem FROM records"""))
def _(spark, sf):
    path = F.concat(F.lit("root/gt/"), "sample_id", F.lit(".png"))
    return fx.records(spark, sf).select(sem.base_name(path).alias("name"), sem.stem(path).alias("stem"))


define("scene_assets", ("obs",), """
  SELECT scene_name, CAST(substr(scene_name, 7) AS INT) AS n, count(DISTINCT obj_id) AS assets FROM obs GROUP BY scene_name""")


@query("s3_handoffs", with_tables(("scene_assets",), """
  SELECT scene_name, code, CASE WHEN code IS NULL THEN assets - CASE WHEN n % 4 = 1 THEN 1 ELSE 0 END ELSE 0 END AS assets FROM (
    SELECT *, CASE WHEN n % 11 = 5 THEN 'not_complete' WHEN n % 7 = 3 THEN 'manifest_hash_mismatch'
                   WHEN n % 5 = 2 AND n % 2 = 1 THEN 'quarantine_hash_mismatch' END AS code FROM scene_assets)"""))
def _(spark, sf):
    """A hand-off for each scene, in three shapes; some incomplete or with a hash of other bytes."""
    root = scratch_path(spark, "handoffs")
    own = _in_folders(F.concat("scene_name", F.lit(".txt")))
    scenes = staged(
        fx.obs(spark, sf).groupBy("scene_name").agg(F.sort_array(F.collect_set("obj_id")).alias("obj_ids")), "scenes"
    )
    lines = F.transform("obj_ids", lambda x: F.concat(F.to_json(F.struct(x.alias("obj_id"))), F.lit("\n")))
    writers.write_files(scenes.select(own.alias("name"), F.array_join(lines, "").alias("content")), f"{root}/manifests")
    files = staged(readers.read_content(spark, f"{root}/manifests", below=True), "contents")
    n = F.substring("scene_name", 7, 10).cast("int")
    named = files.select("path", "sha256", sem.stem(F.col("path")).alias("scene_name")).join(
        scenes.select("scene_name", F.get("obj_ids", F.lit(0)).alias("first")), "scene_name"
    )
    declared = F.when(n % 7 == 3, F.sha2("sha256", 256)).otherwise(F.col("sha256"))
    shape = lambda k, c: F.when(n % 3 == k, c)
    body = F.to_json(
        F.struct(
            F.when(n % 11 == 5, "partial").otherwise("complete").alias("status"),
            shape(0, F.col("path")).alias("manifest"),
            shape(0, declared).alias("manifest_sha256"),
            shape(1, F.struct(F.struct(F.col("path").alias("path"), declared.alias("sha256")).alias("exact_asset_manifest"))).alias("outputs"),
            shape(2, F.col("path")).alias("exact_asset_manifest"),
            shape(2, declared).alias("exact_asset_manifest_sha256"),
            F.when(n % 4 == 1, F.array("first")).alias("excluded_asset_ids"),
            F.when(n % 5 == 2, F.col("path")).alias("quarantine_manifest"),
            F.when(n % 5 == 2, F.when(n % 2 == 1, F.lit("0")).otherwise(F.col("sha256"))).alias("quarantine_manifest_sha256"),
        )
    )
    writers.write_files(named.select(own.alias("name"), body.alias("content")), f"{root}/documents")
    handoffs = staged(readers.read_handoffs(spark, f"{root}/documents", below=True), "handoffs")
    resolved = staged(readers.resolve_handoffs(handoffs, files), "resolved")
    rows = spark.read.schema("obj_id STRING").option("recursiveFileLookup", True).json(f"{root}/manifests").select(
        readers.one_slash(F.col("_metadata.file_path")).alias("manifest"), "obj_id"
    )
    sound = resolved.where(F.col("code").isNull()).select("path", "manifest")
    left = rows.join(sound, "manifest").join(readers.handoff_exclusions(handoffs).withColumnRenamed("asset_id", "obj_id"), ["path", "obj_id"], "left_anti")
    counts = left.groupBy("path").agg(F.count("*").alias("assets"))
    return resolved.join(counts, "path", "left").select(
        sem.stem(F.col("path")).alias("scene_name"), "code", F.coalesce("assets", F.lit(0)).alias("assets")
    )
