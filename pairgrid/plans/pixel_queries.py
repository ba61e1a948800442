"""Queries over pixels: 8 x 8 tiles stand for images, row for row."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairgrid.functions import hashing
from pairgrid.functions.semantics import to_byte
from pairgrid.operators import pixels
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.registry import query
from pairgrid.session import staged

SIDE = 8
_PIXEL = ("sample_id", "ord", "y", "x")
_BYTE = "CAST(round_even(least(255.0::DOUBLE, greatest(0.0::DOUBLE, {} * 255.0::DOUBLE)), 0) AS INT)"


@query("x2_support", with_tables(("tiles",), """
  SELECT sample_id, ord, y, x, alpha > 0.02::DOUBLE AS shown, alpha >= 0.5::DOUBLE AS occluder, alpha > 0 AS edited FROM tiles"""))
def _(spark, sf):
    return fx.tiles(spark, sf).select(
        *_PIXEL, pixels.support(F.col("alpha")).alias("shown"), (F.col("alpha") >= 0.5).alias("occluder"), (F.col("alpha") > 0).alias("edited")
    )


define("painted", ("tiles",), """
  SELECT sample_id, y, x, CASE WHEN len(l) > 2 THEN l[3].c + v2 * (1 - l[3].a) ELSE v2 END AS value FROM (
    SELECT *, CASE WHEN len(l) > 1 THEN l[2].c + v1 * (1 - l[2].a) ELSE v1 END AS v2 FROM (
      SELECT *, l[1].c + 0.5::DOUBLE * (1 - l[1].a) AS v1 FROM (
        SELECT sample_id, y, x, list({'a': alpha, 'c': rgb} ORDER BY depth DESC, ord) AS l FROM tiles GROUP BY ALL)))""")


@query("x3_composite", with_tables(("painted",), f"SELECT sample_id, y, x, {_BYTE.format('value')} AS value FROM painted"))
def _(spark, sf):
    painted = pixels.composite(fx.tiles(spark, sf), F.lit(fx.BACKGROUND))
    return painted.withColumn("value", to_byte(F.col("value")))


@query("x4_cut_foreground", with_tables(("tiles",), """
  SELECT sample_id, ord, y, x, CASE WHEN y < 4 AND e > 0.05::DOUBLE THEN 0.0 ELSE alpha END AS alpha,
         CASE WHEN y < 4 AND e > 0.05::DOUBLE THEN 0.0 ELSE rgb END AS rgb FROM tiles"""))
def _(spark, sf):
    hidden = (F.col("y") < 4) & (F.col("e") > 0.05)
    return fx.tiles(spark, sf).select(
        *_PIXEL, pixels.cut_foreground(F.col("alpha"), hidden).alias("alpha"), pixels.cut_foreground(F.col("rgb"), hidden).alias("rgb")
    )


@query("x5_changed", with_tables(("tiles",), f"""
  SELECT sample_id, ord, y, x, {_BYTE.format('alpha')} <> {_BYTE.format('rgb')} OR y = 7 AS changed FROM tiles"""))
def _(spark, sf):
    last = F.when(F.col("y") == 7, 1).otherwise(0)
    return fx.tiles(spark, sf).select(
        *_PIXEL, pixels.changed([to_byte(F.col("alpha")), F.lit(0)], [to_byte(F.col("rgb")), last]).alias("changed")
    )


@query("x6_overlay", with_tables(("tiles",), """
  SELECT sample_id, y, x, coalesce(max_by(e, ord) FILTER (alpha > 0.1::DOUBLE), 0.5::DOUBLE) AS value,
         bool_or(alpha > 0.1::DOUBLE) AS edited FROM tiles GROUP BY ALL"""))
def _(spark, sf):
    layers = fx.tiles(spark, sf).select(*_PIXEL, (F.col("alpha") > 0.1).alias("mask"), F.col("e").alias("replacement"))
    return pixels.overlay(layers, F.lit(fx.BACKGROUND))


def _scene() -> Column:
    """Scene depth of a tile pixel, with unusable values among them."""
    i = F.col("y") * SIDE + F.col("x")
    return F.when(i % 13 == 0, F.lit(float("nan"))).when(i % 17 == 0, F.lit(0.0)).otherwise(3.0 + i * 7 % 5)


define("depths", ("tiles",), """
  SELECT *, isfinite(scene) AND scene > 0 AND scene + greatest(0.3::DOUBLE, (5.0::DOUBLE + ord) * 0.02::DOUBLE) < 5.0::DOUBLE + ord AS front FROM (
    SELECT *, CASE WHEN i % 13 = 0 THEN 'nan'::DOUBLE WHEN i % 17 = 0 THEN 0.0 ELSE 3.0::DOUBLE + i * 7 % 5 END AS scene
    FROM (SELECT *, y * 8 + x AS i FROM tiles))""")


@query("x8_nearer", with_tables(("depths",), "SELECT sample_id, ord, y, x, front FROM depths"))
def _(spark, sf):
    return fx.tiles(spark, sf).select(*_PIXEL, pixels.nearer(_scene(), 5.0 + F.col("ord")).alias("front"))


@query("a20_median_depth", with_tables(("tiles",), """
  SELECT sample_id, ord, median(e * 10) FILTER (e > 0) AS median_depth_m FROM tiles GROUP BY ALL"""))
def _(spark, sf):
    return pixels.median_depth(fx.tiles(spark, sf).select(*_PIXEL, (F.col("e") * 10).alias("depth")))


@query("a21_mask_stats", with_tables(("tiles",), """
  SELECT sample_id, ord, CAST(count_if(alpha > 0.02::DOUBLE) AS BIGINT) AS support_pixels,
         CAST(count_if(alpha > 0) AS BIGINT) AS edited_pixels, count(*) AS pixels FROM tiles GROUP BY ALL"""))
def _(spark, sf):
    return pixels.mask_stats(fx.tiles(spark, sf))


define("shared_px", ("tiles",), """
  SELECT sample_id, first_ord, second_ord, shared_pixels, shared_pixels / CAST(greatest(least(a, b), 1) AS DOUBLE) AS fraction FROM (
    SELECT l.sample_id, l.ord AS first_ord, r.ord AS second_ord, count(*) AS shared_pixels,
           any_value(s.n) AS a, any_value(t.n) AS b
    FROM tiles l JOIN tiles r ON l.sample_id = r.sample_id AND l.y = r.y AND l.x = r.x AND l.ord < r.ord
    JOIN (SELECT sample_id, ord, count(*) AS n FROM tiles WHERE alpha > 0.02::DOUBLE GROUP BY ALL) s ON s.sample_id = l.sample_id AND s.ord = l.ord
    JOIN (SELECT sample_id, ord, count(*) AS n FROM tiles WHERE alpha > 0.02::DOUBLE GROUP BY ALL) t ON t.sample_id = r.sample_id AND t.ord = r.ord
    WHERE l.alpha > 0.02::DOUBLE AND r.alpha > 0.02::DOUBLE GROUP BY ALL)""")


@query("j17_overlap", with_tables(("shared_px",), "SELECT * FROM shared_px WHERE fraction > 0.02::DOUBLE"))
def _(spark, sf):
    return pixels.edit_overlap(fx.tiles(spark, sf))


# One layer removed and one inserted per sample: ord 0 edits, ord 1 and 2 cover.
def _edited(spark, sf) -> DataFrame:
    t = fx.tiles(spark, sf)

    def of(ord_: int, c: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col("ord") == ord_, c)), F.lit(0.0))

    e, alpha = F.col("e"), F.col("alpha")
    flat = t.groupBy("sample_id", "y", "x").agg(
        of(0, e).alias("e0"), of(0, alpha).alias("a0"), of(1, alpha).alias("a1"), of(2, alpha).alias("a2")
    )
    target = F.lit(0.5)
    removed = F.when(F.col("a0") > 0.04, F.lit(0.25)).otherwise(target)
    inserted = F.when(F.col("a1") > 0.1, F.lit(0.75)).when(F.col("a2") > 0.3, F.lit(0.9)).otherwise(F.col("removed"))
    return (
        flat.withColumn("target", target)
        .withColumn("removed", removed)
        .withColumn("inserted", inserted)
        .withColumn("edit", F.col("a0") > F.when(F.col("y") == 0, F.lit(0.1)).otherwise(F.lit(0.04)))
        .withColumn("covered", (F.col("a1") > 0.02) | ((F.col("a2") > 0.02) & (F.col("x") > 0)))
    )


define("edited", ("tiles",), """
  SELECT *, CASE WHEN a1 > 0.1::DOUBLE THEN 0.75 WHEN a2 > 0.3::DOUBLE THEN 0.9 ELSE removed END::DOUBLE AS inserted,
         a0 > CASE WHEN y = 0 THEN 0.1 ELSE 0.04 END::DOUBLE AS edit, a1 > 0.02::DOUBLE OR (a2 > 0.02::DOUBLE AND x > 0) AS covered FROM (
    SELECT *, CASE WHEN a0 > 0.04::DOUBLE THEN 0.25 ELSE 0.5 END::DOUBLE AS removed FROM (
      SELECT sample_id, y, x, coalesce(max(alpha) FILTER (ord = 0), 0) AS a0, coalesce(max(alpha) FILTER (ord = 1), 0) AS a1,
             coalesce(max(alpha) FILTER (ord = 2), 0) AS a2 FROM tiles GROUP BY ALL))""")


@query("p27_removal", with_tables(("edited",), """
  SELECT * FROM (SELECT sample_id, array_to_string(list_filter([
    CASE WHEN count_if(removed <> 0.5) < 20 THEN 'removal_ineffective' END,
    CASE WHEN count_if(removed <> 0.5 AND NOT edit) > 0 THEN 'removal_outside_mask' END], lambda c: c IS NOT NULL), ',') AS codes
  FROM edited GROUP BY 1) WHERE codes <> ''"""))
def _(spark, sf):
    return pixels.removal_violations(_edited(spark, sf)).withColumn("codes", F.concat_ws(",", "codes"))


@query("p28_insertion", with_tables(("edited",), """
  SELECT * FROM (SELECT sample_id, array_to_string(list_filter([
    CASE WHEN count_if(inserted <> removed) < 20 THEN 'insertion_ineffective' END,
    CASE WHEN count_if(inserted <> 0.5 AND NOT (edit OR covered)) > 0 THEN 'changed_outside_support' END], lambda c: c IS NOT NULL), ',') AS codes
  FROM edited GROUP BY 1) WHERE codes <> ''"""))
def _(spark, sf):
    return pixels.insertion_violations(_edited(spark, sf)).withColumn("codes", F.concat_ws(",", "codes"))


@query("x11_quantize", with_tables(("tiles",), f"""
  SELECT sample_id, ord, sha256(unhex(string_agg(printf('%02x', {_BYTE.format('alpha')}), '' ORDER BY y, x))) AS content_sha256
  FROM tiles GROUP BY ALL"""))
def _(spark, sf):
    bytes_ = fx.tiles(spark, sf).withColumn("byte", to_byte(F.col("alpha")))
    return pixels.pack(bytes_, ["sample_id", "ord"], "byte").select("sample_id", "ord", F.sha2("image", 256).alias("content_sha256"))


@query("x1_pixels", with_tables(("tiles",), f"""
  SELECT sample_id || '/' || ord AS path, 8 AS width, 8 AS height, 3 AS channels,
         sha256(unhex(string_agg(printf('%02x%02x%02x', {_BYTE.format('rgb')}, {_BYTE.format('e')}, {_BYTE.format('alpha')}), '' ORDER BY y, x)))
           AS pixels_sha256
  FROM tiles GROUP BY sample_id, ord"""))
def _(spark, sf):
    # As the image source stores them: blue, green and red of a pixel side by side.
    channels = F.array(*[to_byte(F.col(c)) for c in ("alpha", "e", "rgb")])
    stored = fx.tiles(spark, sf).select("sample_id", "ord", "y", "x", F.posexplode(channels).alias("channel", "byte"))
    stored = stored.withColumn("x", F.col("x") * 3 + F.col("channel"))
    images = pixels.pack(stored, ["sample_id", "ord"], "byte").select(
        F.concat_ws("/", "sample_id", "ord").alias("path"),
        F.lit(SIDE).alias("width"),
        F.lit(SIDE).alias("height"),
        F.lit(3).alias("channels"),
        F.col("image").alias("data"),
    )
    return pixels.decode_pixels(images).select("path", "width", "height", "channels", F.sha2("pixels", 256).alias("pixels_sha256"))


@query("f11_to_byte", with_tables(("tiles",), f"SELECT sample_id, ord, y, x, {_BYTE.format('e')} AS byte FROM tiles"))
def _(spark, sf):
    return fx.tiles(spark, sf).select(*_PIXEL, to_byte(F.col("e")).alias("byte"))


def _components_sql(mask: str, table: str) -> str:
    return f"""
  SELECT sample_id, ord, i, min(root) AS root FROM (
    WITH RECURSIVE px AS (SELECT sample_id, ord, y, x, y * 8 + x AS i FROM {table} WHERE {mask}),
    reach AS (
      SELECT sample_id, ord, y, x, i, i AS root FROM px
      UNION
      SELECT n.sample_id, n.ord, n.y, n.x, n.i, r.root FROM reach r JOIN px n
        ON n.sample_id = r.sample_id AND n.ord = r.ord AND abs(n.y - r.y) <= 1 AND abs(n.x - r.x) <= 1)
    SELECT * FROM reach) GROUP BY ALL"""


define("labels_shown", ("tiles",), _components_sql("alpha > 0.02::DOUBLE", "tiles"))


@query("x7_components", with_tables(("labels_shown",), """
  SELECT sample_id, ord, CAST(row_number() OVER (PARTITION BY sample_id, ord ORDER BY root) AS INT) AS component_index,
         CAST(count(*) AS INT) AS component_pixels, CAST(root AS INT) AS first_pixel FROM labels_shown GROUP BY sample_id, ord, root"""))
def _(spark, sf):
    marked = fx.tiles(spark, sf).withColumn("bit", pixels.support(F.col("alpha")).cast("int"))
    return pixels.components(pixels.pack(marked, ["sample_id", "ord"], "bit").withColumnRenamed("image", "mask"), SIDE, SIDE)


def _floats(c: Column) -> Column:
    """Array of doubles as bytes."""

    @F.pandas_udf("binary")
    def packed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: np.asarray(v, dtype=np.float64).tobytes())

    return packed(c)


def _masked_layers(spark, sf) -> DataFrame:
    """Layers with masks and depth maps: a pixel is hidden where its value is large."""
    t = fx.tiles(spark, sf)
    full = to_byte(F.col("alpha"))
    zero = F.lit(0)

    def packed(c: Column, name: str) -> Column:
        cells = F.transform(F.sort_array(F.collect_list(F.struct("y", "x", c.alias("b")))), lambda p: F.lpad(F.hex(p["b"]), 2, "0"))
        return F.unhex(F.array_join(cells, "")).alias(name)

    def depths(c: Column, name: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct("y", "x", c.alias("d")))), lambda p: p["d"]).alias(name)

    layers = t.groupBy("sample_id", "ord", "depth").agg(
        packed(full, "full_alpha"),
        packed(F.when(F.col("e") > 0.04, zero).otherwise(full), "visible_alpha"),
        packed(F.when(F.col("y") < 4, full).otherwise(zero), "exact_alpha"),
        packed(to_byte(F.col("rgb")), "grey"),
        depths(_scene(), "scene"),
        depths(5.0 + F.col("ord"), "asset"),
    )
    return layers.withColumns({"scene_depth": _floats(F.col("scene")), "asset_depth": _floats(F.col("asset"))}).drop("scene", "asset")


define("hidden_labels", ("depths",), _components_sql(
    f"{_BYTE.format('alpha')} > 5 AND e > 0.04::DOUBLE", "depths"))

define("evidence_x9", ("hidden_labels", "depths"), f"""
  SELECT d.sample_id, d.ord, d.full_px, coalesce(h.selected, 0) AS selected, coalesce(h.hidden, 0) AS hidden,
         coalesce(h.exact, 0) AS exact, greatest(16, CAST(ceil(d.full_px * 0.04::DOUBLE) AS BIGINT)) AS least
  FROM (SELECT sample_id, ord, CAST(count_if({_BYTE.format('alpha')} > 5) AS BIGINT) AS full_px FROM depths GROUP BY ALL) d
  LEFT JOIN (SELECT sample_id, ord, CAST(sum(CASE WHEN seeds >= 4 THEN n ELSE 0 END) AS BIGINT) AS selected, CAST(sum(n) AS BIGINT) AS hidden,
                    CAST(sum(CASE WHEN seeds >= 4 THEN upper_half ELSE 0 END) AS BIGINT) AS exact
             FROM (SELECT l.sample_id, l.ord, l.root, count(*) AS n, count_if(p.front) AS seeds, count_if(p.y < 4) AS upper_half
                   FROM hidden_labels l JOIN depths p ON p.sample_id = l.sample_id AND p.ord = l.ord AND p.i = l.i GROUP BY ALL)
             GROUP BY ALL) h ON h.sample_id = d.sample_id AND h.ord = d.ord""")


@query("x9_occlusion_receipts", with_tables(("evidence_x9",), """
  SELECT sample_id, ord, 5.0::DOUBLE + ord AS median_depth_m,
         CASE WHEN selected >= least THEN full_px ELSE 0 END AS full_projected_pixels,
         CASE WHEN selected >= least THEN selected ELSE 0 END AS selected_occlusion_pixels,
         CASE WHEN selected >= least THEN hidden ELSE 0 END AS renderer_verified_occlusion_pixels,
         CASE WHEN selected >= least THEN hidden - selected ELSE 0 END AS restored_asset_pixels,
         CASE WHEN selected >= least THEN exact ELSE 0 END AS target_exact_overlap_pixels,
         CASE WHEN selected >= least THEN 5.0::DOUBLE + ord END AS target_center_depth_m,
         CASE WHEN selected >= least THEN sha256('{"absolute_depth_margin_m":0.3,"image_shape_hw":[8,8],"minimum_overlap_pixels":' || least
           || ',"relative_depth_margin":0.02,"selected_occlusion_fraction":' || CAST(selected / CAST(full_px AS DOUBLE) AS VARCHAR)
           || ',"target_center_depth_m":' || CAST(5.0::DOUBLE + ord AS VARCHAR) || ',"target_instance_token":"inst"}') END AS fields_sha256,
         selected >= least AS bound FROM evidence_x9"""))
def _(spark, sf):
    names = (
        "full_projected_pixels", "selected_occlusion_pixels", "renderer_verified_occlusion_pixels", "restored_asset_pixels",
        "target_exact_overlap_pixels",
    )
    found = pixels.occlusion_receipts(_masked_layers(spark, sf).withColumn("instance_token", F.lit("inst")), SIDE, SIDE)
    signed = found.withColumn("receipt", pixels.receipt_struct(found, SIDE, SIDE))
    kind, receipt = signed.schema["receipt"].dataType, F.col("receipt")
    some = F.struct(*[receipt[n].alias(n) for n in (
        "target_center_depth_m", "absolute_depth_margin_m", "relative_depth_margin", "minimum_overlap_pixels", "selected_occlusion_fraction",
        "image_shape_hw", "target_instance_token",
    )])
    return signed.select(
        "sample_id", "ord", "median_depth_m", *[F.coalesce(F.col(n).cast("bigint"), F.lit(0)).alias(n) for n in names],
        receipt["target_center_depth_m"].alias("target_center_depth_m"),
        F.when(receipt.isNotNull(), hashing.value_sha(some, hashing.kind_of(signed, some))).alias("fields_sha256"),
        hashing.bound_to_itself(receipt, kind).alias("bound"),
    )


def _image(grey: Column) -> Column:
    """Grey bytes as RGB bytes: every two hex digits three times."""
    return F.unhex(F.regexp_replace(F.hex(grey), "(..)", "$1$1$1"))


def _adapted(spark, sf) -> DataFrame:
    """Tile samples adapted to result rows."""
    layers = staged(_masked_layers(spark, sf), "layers")
    no = F.substring("sample_id", 6, 20).cast("bigint")
    plain = F.unhex(F.repeat(F.lit("80"), SIDE * SIDE * 3))
    dark = F.unhex(F.repeat(F.lit("40"), SIDE * SIDE * 3))
    good = F.struct(F.lit(True).alias("quality_gate_pass"))
    box = F.struct(F.lit(1.0).alias("center_error_px"), F.lit(1.0).alias("width_ratio"), F.lit(1.0).alias("height_ratio"))
    raw = F.struct(
        F.lit(True).alias("quality_gate_pass"),
        good.alias("full_projection_geometry_gate"),
        F.lit(64).alias("target_actor_pixels"),
        F.lit(0).alias("complete_projected_asset_pixels"),
        box.alias("full_projection_bbox_vs_target_sam2"),
        box.alias("visibility_aware_projection_bbox_vs_target_sam2"),
        F.struct(F.lit(0.9).alias("iou")).alias("full_projection_silhouette_vs_target_sam2"),
        F.struct(F.lit(0.9).alias("iou")).alias("visibility_aware_projection_silhouette_vs_target_sam2"),
        F.struct(F.lit(1.0).alias("absolute_error_px")).alias("inserted_bottom_vs_target_sam2"),
        F.struct(F.when(no % 7 == 0, F.lit(120.0)).otherwise(F.lit(1.0)).alias("absolute_error_deg")).alias(
            "inserted_orientation_vs_target_sam2"
        ),
        good.alias("ground_lock"),
        F.struct(F.lit(True).alias("catastrophic_asset_safety_pass")).alias("inserted_appearance_vs_target"),
        F.struct(F.lit(False).alias("degenerate_rectangle_mask")).alias("complete_asset_visibility"),
    )
    rendered = layers.select(
        "*",
        F.concat(F.lit("obj-"), F.col("ord").cast("string")).alias("obj_id"),
        F.lit("inst").alias("instance_token"),
        F.sha2("sample_id", 256).alias("asset_sha256"),
        F.lit(True).alias("exact_identity_verified"),
        F.array(F.lit(4.0), F.lit(1.8), F.lit(1.5)).alias("official_dimensions_m"),
        F.lit("+X").alias("forward_axis"),
        F.lit(True).alias("official_dimensions_applied"),
        F.lit(True).alias("canonical_orientation_applied"),
        F.lit(True).alias("bottom_ground_locked"),
        raw.alias("raw_quality"),
        _image(F.col("grey")).alias("layer_rgb"),
        F.col("exact_alpha").alias("mask"),
        dark.alias("replacement"),
        F.lit(True).alias("usable"),
        (no % 11 != 0).alias("passed"),
        F.sha2(F.concat_ws("|", F.lit("cleanup"), "sample_id", F.col("ord").cast("string")), 256).alias("cleanup_decision_sha256"),
        F.sha2("sample_id", 256).alias("target_sha256"),
        F.when((no % 13 == 0) & (F.col("ord") == 1), F.lit("other")).otherwise(F.lit("same")).alias("gt_sha256"),
    )
    jobs = layers.select("sample_id").distinct().select(
        "sample_id",
        F.col("sample_id").alias("result_ord"),
        F.lit("complete").alias("status"),
        F.lit("scene").alias("scene_name"),
        F.lit(1).alias("frame_index"),
        F.lit("0").alias("camera_id"),
        F.lit("main").alias("render_domain"),
        F.struct(
            F.lit(10).alias("sample_data_timestamp_us"), F.lit(10).alias("camera_exposure_timestamp_us"), F.lit(1.5).alias("normalized_time_seconds")
        ).alias("camera_exposure"),
        F.lit(True).alias("target_quality_gate_pass"),
        plain.alias("target"),
        plain.alias("gt"),
    )
    return pixels.adapt_results(jobs, rendered, SIDE, SIDE)


define("exact_union", ("tiles",), f"""
  SELECT sample_id, y, x, bool_or(y < 4 AND {_BYTE.format('alpha')} > 5) AS removed FROM tiles GROUP BY ALL""")


@query("g8_adapt", with_tables(("evidence_x9", "exact_union"), """
  SELECT a.sample_id, CASE WHEN n % 13 = 0 AND a.layers > 1 THEN 'backgrounds_differ' END AS adapter_code, n % 11 <> 0 AS cleanup_passed, a.layers, a.receipts,
         sha256(unhex(r.hex)) AS removed_sha256
  FROM (SELECT sample_id, CAST(substr(sample_id, 6) AS BIGINT) AS n, count(*) AS layers,
               CAST(count_if(selected >= least) AS BIGINT) AS receipts FROM evidence_x9 GROUP BY ALL) a
  JOIN (SELECT sample_id, string_agg(CASE WHEN removed THEN '404040' ELSE '808080' END, '' ORDER BY y, x) AS hex FROM exact_union GROUP BY 1) r
    ON r.sample_id = a.sample_id"""))
def _(spark, sf):
    return _adapted(spark, sf).select(
        "sample_id", "adapter_code", F.col("original_actor_cleanup_receipt.quality_gate_pass").alias("cleanup_passed"),
        F.size("asset_layers").cast("bigint").alias("layers"),
        F.size(F.filter("asset_layers", lambda x: x["receipt"].isNotNull())).cast("bigint").alias("receipts"),
        F.sha2("removed", 256).alias("removed_sha256"),
    )


def _composed(spark, sf):
    """Compose the adapted samples, one layer of each at a time so that layers do not overlap.

    Some are changed after they were signed: cleanup and occlusion receipts, and the
    declared hashes of sources and layers.
    """
    adapted = _adapted(spark, sf)
    layer = F.explode("asset_layers").alias("_l")
    no = F.substring("sample_id", 6, 20).cast("bigint")
    cleanup, own, receipt = F.col("original_actor_cleanup_receipt"), F.col("_l"), F.col("_l.receipt")
    forged = F.when(no % 2 == 0, receipt.withField("absolute_depth_margin_m", F.lit(0.2))).otherwise(receipt.withField("decision_sha256", F.sha2("sample_id", 256)))
    changed = own.withField("receipt", F.when(receipt.isNotNull() & (no % 5 == 2), forged).otherwise(receipt)).withField(
        "content_sha256.alpha", F.when(no % 9 == 4, F.sha2("sample_id", 256)).otherwise(F.col("_l.content_sha256.alpha"))
    )
    single = adapted.select(*[c for c in adapted.columns if c != "asset_layers"], layer).withColumns(
        {
            "sample_id": F.concat_ws("__", "sample_id", "_l.obj_id"),
            "asset_layers": F.array(changed),
            "original_actor_cleanup_receipt": F.when(no % 10 == 6, cleanup.withField("policy", F.lit("other"))).otherwise(cleanup),
            "source_sha256": F.when(no % 8 == 3, F.col("source_sha256").withField("removed", F.lit("none"))).otherwise(F.col("source_sha256")),
        }
    ).withColumn("result_ord", F.col("sample_id")).drop("_l")
    return pixels.compose(single, "main", "result_ord", SIDE, SIDE)


_F32 = "({}::FLOAT / 255::FLOAT)"
define("solo", ("depths", "exact_union", "evidence_x9", "hidden_labels"), f"""
  SELECT t.sample_id || '__obj-' || t.ord AS sample_id, CAST(substr(t.sample_id, 6) AS BIGINT) AS n, c.layers, t.y, t.x, u.removed,
         s.seeds >= 4 AND e.selected >= e.least AND {_BYTE.format('t.alpha')} > 5 AS hidden, e.selected >= e.least AS masked,
         {_BYTE.format('t.alpha')} AS ab, {_BYTE.format('t.rgb')} AS cb
  FROM depths t JOIN exact_union u ON u.sample_id = t.sample_id AND u.y = t.y AND u.x = t.x
  JOIN evidence_x9 e ON e.sample_id = t.sample_id AND e.ord = t.ord
  JOIN (SELECT sample_id, count(*) AS layers FROM evidence_x9 GROUP BY 1) c ON c.sample_id = t.sample_id
  LEFT JOIN hidden_labels l ON l.sample_id = t.sample_id AND l.ord = t.ord AND l.i = t.i
  LEFT JOIN (SELECT l.sample_id, l.ord, l.root, count_if(p.front) AS seeds FROM hidden_labels l JOIN depths p
               ON p.sample_id = l.sample_id AND p.ord = l.ord AND p.i = l.i GROUP BY ALL) s
    ON s.sample_id = l.sample_id AND s.ord = l.ord AND s.root = l.root""")

define("solo_painted", ("solo",), f"""
  SELECT *, CASE WHEN coalesce(hidden, false) THEN 0 ELSE ab END AS a, CASE WHEN removed THEN 64 ELSE 128 END AS bg,
         CASE WHEN coalesce(hidden, false) THEN {_F32.format('0')} ELSE {_F32.format('cb')} END
         + {_F32.format('CASE WHEN removed THEN 64 ELSE 128 END')}
           * (1::FLOAT - CASE WHEN coalesce(hidden, false) THEN 0::FLOAT ELSE {_F32.format('ab')} END) AS v FROM solo""")

define("solo_outcome", ("solo_painted",), f"""
  SELECT sample_id, CASE WHEN n % 13 = 0 AND layers > 1 THEN 'backgrounds_differ' WHEN n % 11 = 0 OR n % 10 = 6 THEN 'invalid_cleanup_receipt'
         WHEN n % 8 = 3 THEN 'source_hash_mismatch' WHEN n % 7 = 0 THEN 'geometry_candidate' WHEN n % 9 = 4 THEN 'layer_hash_mismatch'
         WHEN n % 5 = 2 AND bool_or(masked) THEN 'receipt_binding_invalid'
         WHEN count_if(removed) < 20 THEN 'removal_ineffective'
         WHEN count_if(ab > 5 AND NOT coalesce(hidden, false)) < 20 OR count_if(ab > 5 AND NOT coalesce(hidden, false)) = 0 THEN 'not_materially_visible'
         WHEN count_if(v <> {_F32.format('bg')}) < 20 THEN 'insertion_ineffective' END AS reason,
         sha256(unhex(string_agg(repeat(printf('%02x', CAST(round_even(least(255::FLOAT, greatest(0::FLOAT, v * 255::FLOAT)), 0) AS INT)), 3), ''
           ORDER BY y, x))) AS input_sha256
  FROM solo_painted GROUP BY sample_id, n, layers""")


@query("g7_compose_accepted", with_tables(("solo_outcome",), "SELECT sample_id, input_sha256 FROM solo_outcome WHERE reason IS NULL"))
def _(spark, sf):
    accepted, _ = _composed(spark, sf)
    return accepted.select("sample_id", F.col("content_sha256.input").alias("input_sha256"))


@query("g7_compose_rejected", with_tables(("solo_outcome",), "SELECT sample_id, reason FROM solo_outcome WHERE reason IS NOT NULL"))
def _(spark, sf):
    _, rejected = _composed(spark, sf)
    return rejected.select("sample_id", "reason")
