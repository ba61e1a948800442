"""Quality gates as column rules: geometry, identity, occlusion and result checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from pairgrid.functions.hashing import bound_to_itself
from pairgrid.functions.semantics import (
    FORWARD_AXIS,
    at_least,
    codes,
    finite,
    is_hash,
    is_true,
    not_true,
    text,
    value_or,
)

INF = float("inf")

# Geometry limits by projected size. ``below`` is exclusive; the
# last row has no upper end.
GEOMETRY_LIMITS = (
    # below, iou, centre, ratio low, ratio high, bottom, yaw
    (100, 0.30, 12.0, 0.70, 1.40, 10.0, 25.0),
    (400, 0.33, 11.0, 0.72, 1.37, 10.0, 25.0),
    (1600, 0.36, 10.0, 0.75, 1.33, 10.0, 24.0),
    (None, 0.40, 10.0, 0.78, 1.30, 10.0, 22.0),
)
_LIMIT_NAMES = ("iou", "center", "ratio_low", "ratio_high", "bottom", "yaw")

# Cleanup and occlusion policies.
CLEANUP_POLICY = "union_of_hash_bound_legacy_actor_cleanup_masks_v1"
OCCLUSION_POLICY = "distinct_nearer_official_or_static_depth_v1"
STATIC_EVIDENCE = "unannotated_static_depth_seed_region"
STATIC_REGION = "legacy-renderer-scene-depth"
MATERIAL_PIXELS = 16
MATERIAL_SHARE = 0.04
VISIBLE_PIXELS = 20
VISIBLE_SHARE = 0.15
CLEAR_REVERSAL_DEG = 90.0


@dataclass(frozen=True)
class Limits:
    iou: Column
    center: Column
    ratio_low: Column
    ratio_high: Column
    bottom: Column
    yaw: Column


def geometry_thresholds(pixels: Column) -> Limits:
    """Limits for a projected size, one ``when`` chain per limit."""

    def pick(i: int) -> Column:
        out = None
        for row in GEOMETRY_LIMITS:
            value = F.lit(row[i + 1])
            if row[0] is None:
                return out.otherwise(value)
            out = F.when(pixels < row[0], value) if out is None else out.when(pixels < row[0], value)

    return Limits(*[pick(i) for i in range(len(_LIMIT_NAMES))])


def projected_pixels(q: Column) -> Column:
    return F.greatest(value_or(q["target_actor_pixels"], 0), value_or(q["complete_projected_asset_pixels"], 0))


def hard_safety(q: Column) -> Column:
    yaw = q["orientation_error_deg"]
    return (
        is_true(q["ground_lock_pass"])
        & is_true(q["catastrophic_asset_safety_pass"])
        & not_true(q["broken_or_doubled_asset"])
        & (yaw.isNull() | F.coalesce(F.abs(yaw) < CLEAR_REVERSAL_DEG, F.lit(False)))
    )


def strict_proof(q: Column) -> Column:
    return is_true(q["renderer_quality_gate_pass"]) & is_true(q["renderer_geometry_gate_pass"])


def adaptive_proof(q: Column) -> Column:
    """Numeric proof; the yaw test is one-sided and occlusion waives the bottom error."""
    limits = geometry_thresholds(projected_pixels(q))
    yaw = q["orientation_error_deg"]
    width, height = value_or(q["width_ratio"], 0.0), value_or(q["height_ratio"], 0.0)
    return (
        at_least(value_or(q["silhouette_iou"], 0.0), limits.iou)
        & (value_or(q["center_error_px"], INF) <= limits.center)
        & width.between(limits.ratio_low, limits.ratio_high)
        & height.between(limits.ratio_low, limits.ratio_high)
        & (is_true(q["verified_foreground_occlusion_applied"]) | (value_or(q["bottom_error_px"], INF) <= limits.bottom))
        & (yaw.isNull() | F.coalesce(yaw <= limits.yaw, F.lit(False)))
    )


def geometry_pass(q: Column) -> Column:
    return hard_safety(q) & (strict_proof(q) | adaptive_proof(q))


def dimensions_ok(c: Column) -> Column:
    return F.coalesce((F.size(c) == 3) & F.forall(c, lambda v: F.coalesce(v > 0, F.lit(False))), F.lit(False))


def layer_violations(layer: Column) -> Column:
    """Codes for one rendered layer."""
    q = layer["quality"]
    return codes(
        {
            "identity_not_verified": not_true(layer["exact_identity_verified"]),
            "invalid_asset_hash": ~is_hash(layer["asset_sha256"]),
            "wrong_forward_axis": text(layer["forward_axis"]) != FORWARD_AXIS,
            "dimensions_not_applied": not_true(layer["official_dimensions_applied"]),
            "orientation_not_applied": not_true(layer["canonical_orientation_applied"]),
            "not_ground_locked": not_true(layer["bottom_ground_locked"]),
            "degenerate_rectangle": is_true(q["degenerate_rectangle_mask"]),
            "geometry_candidate": ~geometry_pass(q),
            "invalid_dimensions": ~dimensions_ok(layer["official_dimensions_m"]),
        }
    )


def cleanup_receipt(usable: Column, passed: Column, sources: Column) -> Column:
    """What one sample's layers say of the removed actor: all must be usable and passed. Not yet signed."""
    return F.struct(
        F.lit(1).alias("schema_version"),
        F.lit(CLEANUP_POLICY).alias("policy"),
        usable.alias("observation_technical_usable"),
        passed.alias("quality_gate_pass"),
        sources.alias("source_decision_sha256"),
    )


def result_violations(r: Column, kind: T.StructType, expected_domain: Column) -> Column:
    """Codes for one renderer result of type ``kind``; its cleanup receipt must carry its own hash."""
    exposure, cleanup = r["camera_exposure"], r["original_actor_cleanup_receipt"]
    stamp = value_or(exposure["sample_data_timestamp_us"], 0)
    time = F.nullif(exposure["normalized_time_seconds"], F.lit(0.0))
    return codes(
        {
            "missing_sample_id": text(r["sample_id"]) == "",
            "incomplete": text(r["status"]) != "complete",
            "wrong_render_domain": ~F.coalesce(r["render_domain"] == expected_domain, F.lit(False)),
            "exposure_not_bound": (stamp <= 0)
            | (value_or(exposure["camera_exposure_timestamp_us"], 0) != stamp)
            | ~finite(time),
            "invalid_cleanup_receipt": ~bound_to_itself(cleanup, kind["original_actor_cleanup_receipt"].dataType)
            | not_true(cleanup["observation_technical_usable"])
            | not_true(cleanup["quality_gate_pass"]),
            "target_quality_failed": not_true(r["target_quality_gate_pass"]),
        }
    )


def official_evidence(receipt: Column) -> Column:
    """Annotated occluders that count as proof; an absent verdict counts as accepted."""
    return F.filter(
        F.coalesce(receipt["official_instance_decisions"], F.array()),
        lambda d: is_true(d["is_distinct_from_target"])
        & is_true(d["official_annotation_bound"])
        & is_true(d["strictly_nearer_than_target"])
        & F.coalesce(d["accepted"], F.lit(True)),
    )


def static_evidence(receipt: Column) -> Column:
    """Static depth regions whose accepted components are exactly the declared ones."""

    def proven(d: Column) -> Column:
        seeds = F.coalesce(
            F.nullif(d["minimum_verified_seed_pixels_per_component"], F.lit(0)),
            F.nullif(receipt["minimum_static_seed_pixels"], F.lit(0)),
            F.lit(1),
        )
        accepted = F.transform(
            F.filter(
                F.coalesce(d["components"], F.array()),
                lambda c: (value_or(c["verified_nearer_seed_pixels"], 0) >= seeds) & is_true(c["accepted"]),
            ),
            lambda c: value_or(c["component_index"], 0),
        )
        return (
            (text(d["evidence_kind"]) == STATIC_EVIDENCE)
            & is_true(d["accepted"])
            & (F.size(accepted) > 0)
            & F.coalesce(accepted == d["accepted_component_indices"], F.lit(False))
            & (value_or(d["selected_pixels"], 0) > 0)
        )

    return F.filter(F.coalesce(receipt["static_region_decisions"], F.array()), proven)


def receipt_violations(receipt: Column, kind: T.StructType) -> Column:
    """Codes for an occlusion receipt of type ``kind``; a versioned one must carry its own hash."""
    versioned = receipt["schema_version"].isNotNull()
    static = F.size(static_evidence(receipt)) > 0
    hashes = (
        is_hash(receipt["scene_depth_sha256"])
        & is_hash(receipt["asset_depth_sha256"])
        & is_hash(receipt["nearer_depth_support_sha256"])
    )
    return codes(
        {
            "receipt_binding_invalid": versioned
            & (
                (receipt["schema_version"] != 1)
                | (text(receipt["policy"]) != OCCLUSION_POLICY)
                | ~bound_to_itself(receipt, kind)
                | not_true(receipt["quality_gate_pass"])
            ),
            "depth_evidence_not_hash_bound": versioned & static & ~hashes,
            "no_independent_proof": ((F.size(official_evidence(receipt)) == 0) & ~static)
            | not_true(receipt["independent_foreground_verified"]),
        }
    )


def material_pixels(support: Column) -> Column:
    """Least number of occluded pixels that matters for a given support."""
    return F.greatest(F.lit(MATERIAL_PIXELS), F.ceil(support * F.lit(MATERIAL_SHARE)).cast("long"))


def kept_occlusion(pixels: Column, support: Column) -> Column:
    """Immaterial occlusion counts as none."""
    return F.when(pixels >= material_pixels(support), pixels).otherwise(F.lit(0))


def occlusion_applied(pixels: Column, support: Column) -> Column:
    return pixels >= material_pixels(support)


def occlusion_regression(renderer: Column, restored: Column, pixels: Column, support: Column) -> Column:
    least = material_pixels(support)
    renderer, restored = value_or(renderer, 0), value_or(restored, 0)
    return (renderer >= least) & (restored >= least) & (renderer - pixels >= least)


def visible_enough(visible: Column, complete: Column) -> Column:
    """Visible pixels against the complete asset; without a count the visible part is the whole."""
    whole = F.coalesce(F.nullif(complete, F.lit(0)), visible)
    return (visible >= VISIBLE_PIXELS) & (visible / F.greatest(whole, F.lit(1)) >= VISIBLE_SHARE)


# Where each flat quality field comes from. ``{view}`` is the
# visibility-aware or the full projection.
_METRIC_PATHS = {
    "silhouette_iou": "{view}_projection_silhouette_vs_target_sam2.iou",
    "center_error_px": "{view}_projection_bbox_vs_target_sam2.center_error_px",
    "width_ratio": "{view}_projection_bbox_vs_target_sam2.width_ratio",
    "height_ratio": "{view}_projection_bbox_vs_target_sam2.height_ratio",
    "bottom_error_px": "inserted_bottom_vs_target_sam2.absolute_error_px",
    "orientation_error_deg": "inserted_orientation_vs_target_sam2.absolute_error_deg",
}
_FLAG_PATHS = {
    "renderer_quality_gate_pass": "quality_gate_pass",
    "renderer_geometry_gate_pass": "full_projection_geometry_gate.quality_gate_pass",
    "ground_lock_pass": "ground_lock.quality_gate_pass",
    "catastrophic_asset_safety_pass": "inserted_appearance_vs_target.catastrophic_asset_safety_pass",
    "degenerate_rectangle_mask": "complete_asset_visibility.degenerate_rectangle_mask",
}


def normalize_quality(raw: Column, occluded: Column) -> Column:
    """Flat quality struct from the renderer's nested metrics."""

    def at(path: str) -> Column:
        c = raw
        for part in path.split("."):
            c = c[part]
        return c

    def metric(path: str) -> Column:
        if "{view}" not in path:
            return at(path)
        return F.when(is_true(occluded), at(path.format(view="visibility_aware"))).otherwise(at(path.format(view="full")))

    fields = [value_or(at(n), 0).cast("long").alias(n) for n in ("target_actor_pixels", "complete_projected_asset_pixels")]
    fields += [metric(p).cast("double").alias(n) for n, p in _METRIC_PATHS.items()]
    fields += [is_true(at(p)).alias(n) for n, p in _FLAG_PATHS.items()]
    fields += [F.lit(False).alias("broken_or_doubled_asset"), is_true(occluded).alias("verified_foreground_occlusion_applied")]
    return F.struct(*fields)
