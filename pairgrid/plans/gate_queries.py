"""Queries over the quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairgrid.functions import gates, hashing
from pairgrid.functions.semantics import nonzero_or
from pairgrid.operators.pixels import order_layers
from pairgrid.plans import fixtures as fx
from pairgrid.plans.fixture_sql import define, with_tables
from pairgrid.plans.registry import query

_KEY = ("sample_id", "obj_id")


def _q():
    return F.col("quality")


@query("p10_thresholds", with_tables(("gated",), """
  SELECT sample_id, obj_id, px AS pixels, lim_iou AS iou, lim_center AS center, lim_low AS ratio_low,
         lim_high AS ratio_high, lim_bottom AS bottom, lim_yaw AS yaw FROM gated"""))
def _(spark, sf):
    limits = gates.geometry_thresholds(F.col("pixels"))
    return (
        fx.layers(spark, sf)
        .select(*_KEY, gates.projected_pixels(_q()).alias("pixels"))
        .select("*", *[c.alias(n) for n, c in vars(limits).items()])
    )


@query("p11_geometry_pass", with_tables(("gate",), """
  SELECT sample_id, obj_id, hard_ok, strict_ok, adaptive_ok, geometry_ok FROM gate"""))
def _(spark, sf):
    return fx.layers(spark, sf).select(
        *_KEY,
        gates.hard_safety(_q()).alias("hard_ok"),
        gates.strict_proof(_q()).alias("strict_ok"),
        gates.adaptive_proof(_q()).alias("adaptive_ok"),
        gates.geometry_pass(_q()).alias("geometry_ok"),
    )


define("layer_codes", ("gate",), """
  SELECT *, list_filter([
    CASE WHEN NOT exact_identity_verified THEN 'identity_not_verified' END,
    CASE WHEN length(asset_sha256) <> 64 THEN 'invalid_asset_hash' END,
    CASE WHEN forward_axis <> '+X' THEN 'wrong_forward_axis' END,
    CASE WHEN NOT official_dimensions_applied THEN 'dimensions_not_applied' END,
    CASE WHEN NOT canonical_orientation_applied THEN 'orientation_not_applied' END,
    CASE WHEN NOT bottom_ground_locked THEN 'not_ground_locked' END,
    CASE WHEN degenerate THEN 'degenerate_rectangle' END,
    CASE WHEN NOT geometry_ok THEN 'geometry_candidate' END,
    CASE WHEN dim_h <= 0 THEN 'invalid_dimensions' END], lambda c: c IS NOT NULL) AS codes FROM gate""")


@query("p14_layer_violations", with_tables(("layer_codes",), """
  SELECT sample_id, obj_id, array_to_string(codes, ',') AS codes FROM layer_codes"""))
def _(spark, sf):
    df = fx.layers(spark, sf)
    layer = F.struct(*df.columns)
    return df.select(*_KEY, F.concat_ws(",", gates.layer_violations(layer)).alias("codes"))


define("results", ("obs",), """
  SELECT *, CASE WHEN q = 3 THEN 'failed' ELSE 'complete' END AS status,
         CASE WHEN d = 1 AND q < 20 THEN 'other' ELSE 'main' END AS domain,
         CASE WHEN q = 4 THEN 0 ELSE 1000 + pk END AS stamp,
         CASE WHEN q = 5 THEN 1 ELSE 1000 + pk END AS exposed,
         CASE WHEN q = 6 THEN 'nan'::DOUBLE WHEN q = 7 THEN 'inf'::DOUBLE ELSE d / 4.0::DOUBLE END AS secs
  FROM obs""")


def _results(spark, sf):
    o = fx.obs(spark, sf)
    q, d, pk = F.col("q"), F.col("d"), F.col("pk")
    cleanup = F.struct(
        F.when(q != 8, F.lit(True)).alias("observation_technical_usable"), (q != 9).alias("quality_gate_pass"), (d / 8.0).alias("share")
    )
    # The tenth is changed after it was signed: a field where d is even, else the hash.
    own = hashing.signed(o, cleanup)
    changed = F.when(d % 2 == 0, own.withField("share", F.col("share_before"))).otherwise(own.withField("decision_sha256", F.sha2("obj_id", 256)))
    return o.withColumn("share_before", d / 8.0 + 0.25).select(
        "scene_name", "frame_index", "camera_id", "obj_id",
        F.concat_ws("__", "scene_name", "frame_index", "camera_id", "obj_id").alias("sample_id"),
        F.when(q == 3, F.lit("failed")).otherwise(F.lit("complete")).alias("status"),
        F.when((d == 1) & (q < 20), F.lit("other")).otherwise(F.lit("main")).alias("render_domain"),
        F.struct(
            F.when(q == 4, F.lit(0)).otherwise(1000 + pk).alias("sample_data_timestamp_us"),
            F.when(q == 5, F.lit(1)).otherwise(1000 + pk).alias("camera_exposure_timestamp_us"),
            F.when(q == 6, F.lit(float("nan"))).when(q == 7, F.lit(float("inf"))).otherwise(d / 4.0).alias(
                "normalized_time_seconds"
            ),
        ).alias("camera_exposure"),
        F.when(q == 10, changed).otherwise(own).alias("original_actor_cleanup_receipt"),
        (F.col("t") != 0).alias("target_quality_gate_pass"),
    )


@query("p15_result_violations", with_tables(("results",), """
  SELECT scene_name, frame_index, camera_id, obj_id, array_to_string(list_filter([
    CASE WHEN status <> 'complete' THEN 'incomplete' END,
    CASE WHEN domain <> 'main' THEN 'wrong_render_domain' END,
    CASE WHEN stamp <= 0 OR exposed <> stamp OR isnan(secs) OR isinf(secs) OR secs = 0 THEN 'exposure_not_bound' END,
    CASE WHEN q IN (8, 9, 10) THEN 'invalid_cleanup_receipt' END,
    CASE WHEN t = 0 THEN 'target_quality_failed' END], lambda c: c IS NOT NULL), ',') AS codes FROM results"""))
def _(spark, sf):
    df = _results(spark, sf)
    return df.select(
        "scene_name", "frame_index", "camera_id", "obj_id",
        F.concat_ws(",", gates.result_violations(F.struct(*df.columns), df.schema, F.lit("main"))).alias("codes"),
    )


def _receipts(spark, sf):
    """Occlusion receipts: official and static evidence whose flags follow the row's numbers."""
    o = fx.obs(spark, sf)
    q, d, t, pk, sk = (F.col(c) for c in ("q", "d", "t", "pk", "sk"))
    good = F.sha2(F.col("obj_id"), 256)

    def component(i: int):
        return F.struct(
            F.lit(i).alias("component_index"),
            ((pk + i * sk) % 9).alias("verified_nearer_seed_pixels"),
            ((pk + i) % 5 != 0).alias("accepted"),
        )

    declared = F.when(d >= 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    plain = o.select(
        "scene_name", "frame_index", "camera_id", "obj_id", "q", "d", "t", "pk", "sk",
        F.struct(
            (pk / 7.0).alias("target_center_depth_m"),
            F.when(t > 2, F.when(q == 50, F.lit(2)).otherwise(F.lit(1))).alias("schema_version"),
            F.when(q != 49, F.lit(gates.OCCLUSION_POLICY)).alias("policy"),
            (q != 48).alias("quality_gate_pass"),
            (q != 47).alias("independent_foreground_verified"),
            good.alias("scene_depth_sha256"),
            F.when(q != 46, good).alias("asset_depth_sha256"),
            good.alias("nearer_depth_support_sha256"),
            F.lit(4).alias("minimum_static_seed_pixels"),
            F.array(
                F.struct(
                    (pk % 2 == 0).alias("is_distinct_from_target"),
                    (sk % 2 == 0).alias("official_annotation_bound"),
                    F.when(sk % 3 != 0, F.lit(True)).alias("strictly_nearer_than_target"),
                    F.when(pk % 3 == 0, q > 10).alias("accepted"),
                )
            ).alias("official_instance_decisions"),
            F.array(
                F.struct(
                    F.lit(gates.STATIC_EVIDENCE).alias("evidence_kind"),
                    F.when(t < 6, 3).alias("minimum_verified_seed_pixels_per_component"),
                    F.array(component(1), component(2)).alias("components"),
                    declared.alias("accepted_component_indices"),
                    (q - 2).alias("selected_pixels"),
                    (q != 20).alias("accepted"),
                )
            ).alias("static_region_decisions"),
        ).alias("receipt"),
    )
    # Where d is 0 a receipt is changed after it was signed: its depth, or its hash.
    own = hashing.signed(plain, F.col("receipt"))
    late, even = d == 0, pk % 2 == 0
    changed = own.withField("target_center_depth_m", F.when(late & even, pk / 7.0 + 1e-9).otherwise(own["target_center_depth_m"])).withField(
        "decision_sha256", F.when(late & ~even, F.lit("")).otherwise(own["decision_sha256"])
    )
    return plain.withColumn("receipt", changed)


define("receipts", ("obs",), """
  SELECT *, CASE WHEN official AND pk % 3 = 0 THEN q > 10 ELSE official END AS official_ok,
         q <> 20 AND q > 2 AND len(found) > 0 AND found = declared AS static_ok,
         t > 2 AS versioned
  FROM (SELECT *, pk % 2 = 0 AND sk % 2 = 0 AND sk % 3 <> 0 AS official,
               CASE WHEN d >= 5 THEN [1, 2] ELSE [1] END AS declared,
               list_filter([1, 2], lambda i: (pk + i * sk) % 9 >= CASE WHEN t < 6 THEN 3 ELSE 4 END
                                             AND (pk + i) % 5 <> 0) AS found FROM obs)""")


@query("p16_official_evidence", with_tables(("receipts",), """
  SELECT scene_name, frame_index, camera_id, obj_id, CAST(official_ok AS BIGINT) AS proofs FROM receipts"""))
def _(spark, sf):
    return _receipts(spark, sf).select(
        "scene_name", "frame_index", "camera_id", "obj_id",
        F.size(gates.official_evidence(F.col("receipt"))).cast("bigint").alias("proofs"),
    )


@query("p17_static_evidence", with_tables(("receipts",), """
  SELECT scene_name, frame_index, camera_id, obj_id, CAST(static_ok AS BIGINT) AS proofs FROM receipts"""))
def _(spark, sf):
    return _receipts(spark, sf).select(
        "scene_name", "frame_index", "camera_id", "obj_id",
        F.size(gates.static_evidence(F.col("receipt"))).cast("bigint").alias("proofs"),
    )


@query("p18_receipt_violations", with_tables(("receipts",), """
  SELECT scene_name, frame_index, camera_id, obj_id, array_to_string(list_filter([
    CASE WHEN versioned AND (q IN (48, 49, 50) OR d = 0) THEN 'receipt_binding_invalid' END,
    CASE WHEN versioned AND static_ok AND q = 46 THEN 'depth_evidence_not_hash_bound' END,
    CASE WHEN NOT (official_ok OR static_ok) OR q = 47 THEN 'no_independent_proof' END], lambda c: c IS NOT NULL), ',') AS codes
  FROM receipts"""))
def _(spark, sf):
    df = _receipts(spark, sf)
    return df.select(
        "scene_name", "frame_index", "camera_id", "obj_id",
        F.concat_ws(",", gates.receipt_violations(F.col("receipt"), df.schema["receipt"].dataType)).alias("codes"),
    )


# Pixel counts of a layer: support, occluded, renderer-claimed and restored pixels.
_COUNTS = """
  SELECT sample_id, obj_id, complete_px, actor_px AS support, pk % 97 AS pixels, pk % 150 AS renderer, sk * 3 AS restored,
         greatest(16, CAST(ceil(actor_px * 0.04::DOUBLE) AS BIGINT)) AS material FROM layers"""
define("counts", ("layers",), _COUNTS)


def _counts(spark, sf):
    return fx.layers(spark, sf).select(
        *_KEY,
        _q()["complete_projected_asset_pixels"].alias("complete"),
        _q()["target_actor_pixels"].alias("support"),
        (F.col("pk") % 97).alias("pixels"),
        (F.col("pk") % 150).alias("renderer"),
        (F.col("sk") * 3).alias("restored"),
    )


@query("p19_material", with_tables(("counts",), """
  SELECT sample_id, obj_id, material, CASE WHEN pixels >= material THEN pixels ELSE 0 END AS kept,
         pixels >= material AS applied FROM counts"""))
def _(spark, sf):
    pixels, support = F.col("pixels"), F.col("support")
    return _counts(spark, sf).select(
        *_KEY, gates.material_pixels(support).alias("material"), gates.kept_occlusion(pixels, support).alias("kept"),
        gates.occlusion_applied(pixels, support).alias("applied"),
    )


@query("p20_regression", with_tables(("counts",), """
  SELECT sample_id, obj_id, renderer >= material AND restored >= material AND renderer - pixels >= material AS regression
  FROM counts"""))
def _(spark, sf):
    return _counts(spark, sf).select(
        *_KEY,
        gates.occlusion_regression(F.col("renderer"), F.col("restored"), F.col("pixels"), F.col("support")).alias("regression"),
    )


@query("p21_visible", with_tables(("counts",), """
  SELECT sample_id, obj_id, pixels >= 20 AND CAST(pixels AS DOUBLE) /
         greatest(CASE WHEN complete_px = 0 THEN pixels ELSE complete_px END, 1) >= 0.15::DOUBLE AS visible FROM counts"""))
def _(spark, sf):
    return _counts(spark, sf).select(*_KEY, gates.visible_enough(F.col("pixels"), F.col("complete")).alias("visible"))


@query("p22_quality", with_tables(("layers",), """
  SELECT sample_id, obj_id, actor_px AS target_actor_pixels, complete_px AS complete_projected_asset_pixels,
         CASE WHEN occluded THEN (pk % 50) / 50.0::DOUBLE ELSE iou END AS silhouette_iou,
         CASE WHEN occluded THEN center / 2 ELSE center END AS center_error_px,
         CASE WHEN occluded THEN height ELSE width END AS width_ratio, bottom AS bottom_error_px,
         yaw AS orientation_error_deg, ground_ok AS ground_lock_pass, strict_q AS renderer_quality_gate_pass,
         strict_g AS renderer_geometry_gate_pass, occluded AS verified_foreground_occlusion_applied,
         degenerate AS degenerate_rectangle_mask FROM layers"""))
def _(spark, sf):
    def box(center, width, height):
        return F.struct(center.alias("center_error_px"), width.alias("width_ratio"), height.alias("height_ratio"))

    raw = F.struct(
        _q()["target_actor_pixels"].alias("target_actor_pixels"),
        _q()["complete_projected_asset_pixels"].alias("complete_projected_asset_pixels"),
        _q()["renderer_quality_gate_pass"].alias("quality_gate_pass"),
        F.struct(_q()["renderer_geometry_gate_pass"].alias("quality_gate_pass")).alias("full_projection_geometry_gate"),
        box(_q()["center_error_px"], _q()["width_ratio"], _q()["height_ratio"]).alias("full_projection_bbox_vs_target_sam2"),
        box(_q()["center_error_px"] / 2, _q()["height_ratio"], _q()["width_ratio"]).alias(
            "visibility_aware_projection_bbox_vs_target_sam2"
        ),
        F.struct(_q()["silhouette_iou"].alias("iou")).alias("full_projection_silhouette_vs_target_sam2"),
        F.struct(((F.col("pk") % 50) / 50.0).alias("iou")).alias("visibility_aware_projection_silhouette_vs_target_sam2"),
        F.struct(_q()["bottom_error_px"].alias("absolute_error_px")).alias("inserted_bottom_vs_target_sam2"),
        F.struct(_q()["orientation_error_deg"].alias("absolute_error_deg")).alias("inserted_orientation_vs_target_sam2"),
        F.struct(_q()["ground_lock_pass"].alias("quality_gate_pass")).alias("ground_lock"),
        F.struct(_q()["catastrophic_asset_safety_pass"].alias("catastrophic_asset_safety_pass")).alias(
            "inserted_appearance_vs_target"
        ),
        F.struct(_q()["degenerate_rectangle_mask"].alias("degenerate_rectangle_mask")).alias("complete_asset_visibility"),
    )
    flat = gates.normalize_quality(raw, _q()["verified_foreground_occlusion_applied"])
    return fx.layers(spark, sf).select(*_KEY, flat.alias("f")).select(
        *_KEY,
        *[
            f"f.{n}"
            for n in (
                "target_actor_pixels", "complete_projected_asset_pixels", "silhouette_iou", "center_error_px",
                "width_ratio", "bottom_error_px", "orientation_error_deg", "ground_lock_pass",
                "renderer_quality_gate_pass", "renderer_geometry_gate_pass",
                "verified_foreground_occlusion_applied", "degenerate_rectangle_mask",
            )
        ],
    )


@query("w6_layer_order", with_tables(("layers",), """
  SELECT sample_id, obj_id, row_number() OVER (PARTITION BY sample_id ORDER BY
         CASE WHEN median_depth_m = 0 THEN 'inf'::DOUBLE ELSE median_depth_m END DESC, obj_id) AS paint_order FROM layers"""))
def _(spark, sf):
    df = fx.layers(spark, sf).select(*_KEY, nonzero_or(F.col("median_depth_m"), float("inf")).alias("median_depth_m"))
    return order_layers(df, "sample_id", "median_depth_m", "obj_id").select(
        *_KEY, F.col("paint_order").cast("bigint").alias("paint_order")
    )
