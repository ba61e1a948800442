"""Pixel work: long-form rules for tiles, Arrow batches for whole images.

The long form has one row per pixel and layer and stays inside Spark SQL. Whole
images are binary columns of one row per sample; a task holds a small batch of
them at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pairgrid.functions import arrays, png
from pairgrid.functions.gates import (
    OCCLUSION_POLICY,
    STATIC_EVIDENCE,
    STATIC_REGION,
    cleanup_receipt,
    layer_violations,
    normalize_quality,
    occlusion_applied,
    occlusion_regression,
    receipt_violations,
    result_violations,
    visible_enough,
)
from pairgrid.functions.hashing import signed
from pairgrid.functions.semantics import IMAGE_HEIGHT, IMAGE_WIDTH, codes, is_hash, is_true, nonzero_or, text, value_or

PIXEL = ["sample_id", "y", "x"]


# --- long form -----------------------------------------------------------


def order_layers(layers: DataFrame, sample: str = "sample_id", depth: str = "median_depth_m", tie: str = "ord") -> DataFrame:
    """Paint order within a sample: far to near, ties in input order. A sample has few layers."""
    w = Window.partitionBy(sample).orderBy(F.desc(depth), tie)
    return layers.withColumn("paint_order", F.row_number().over(w))


def support(alpha: Column, threshold: float = arrays.SUPPORT) -> Column:
    return alpha > threshold


def cut_foreground(value: Column, hidden: Column) -> Column:
    return F.when(hidden, F.lit(0.0)).otherwise(value)


def changed(before: list[Column], after: list[Column]) -> Column:
    """Does any channel differ?"""
    differences = [F.abs(a - b) for a, b in zip(before, after)]
    return (F.greatest(*differences) if len(differences) > 1 else differences[0]) > 0


def composite(layers: DataFrame, background: Column) -> DataFrame:
    """Paint premultiplied layers over the background, pixel by pixel."""
    stack = F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("far"), "ord", "alpha", "rgb")))
    painted = F.aggregate(
        "stack", background.cast("double"), lambda out, layer: layer["rgb"] + out * (F.lit(1.0) - layer["alpha"])
    )
    return layers.groupBy(*PIXEL).agg(stack.alias("stack")).select(*PIXEL, painted.alias("value"))


def overlay(layers: DataFrame, base: Column) -> DataFrame:
    """Replace the base under each layer's mask, later layers winning; and the union of masks."""
    return layers.groupBy(*PIXEL).agg(
        F.coalesce(F.max_by("replacement", F.when(F.col("mask"), F.col("ord"))), base).alias("value"),
        F.bool_or("mask").alias("edited"),
    )


def nearer(scene: Column, asset: Column) -> Column:
    """Both depths finite and positive, and the scene in front by the larger of two margins."""
    inf = F.lit(float("inf"))
    usable = (scene > 0) & (scene < inf) & (asset > 0) & (asset < inf)
    margin = F.greatest(F.lit(arrays.DEPTH_MARGIN_M), asset * F.lit(arrays.DEPTH_MARGIN_SHARE))
    return F.coalesce(usable & (scene + margin < asset), F.lit(False))


def median_depth(layers: DataFrame, depth: str = "depth") -> DataFrame:
    """Median of the positive finite depths per layer; null when there are none."""
    good = F.when((F.col(depth) > 0) & (F.col(depth) < F.lit(float("inf"))), F.col(depth))
    return layers.groupBy("sample_id", "ord").agg(F.median(good).alias("median_depth_m"))


def mask_stats(layers: DataFrame) -> DataFrame:
    """Support, edited and total pixels per layer."""
    return layers.groupBy("sample_id", "ord").agg(
        F.count_if(support(F.col("alpha"))).alias("support_pixels"),
        F.count_if(F.col("alpha") > 0).alias("edited_pixels"),
        F.count(F.lit(1)).alias("pixels"),
    )


def overlap_fractions(layers: DataFrame) -> DataFrame:
    """Shared pixels of the layer pairs that meet, against the smaller layer.

    Pairs arise only where two layers cover one pixel, never from all layers of
    a sample.
    """
    shown = layers.filter(support(F.col("alpha"))).select(*PIXEL, "ord")
    sizes = shown.groupBy("sample_id", "ord").agg(F.count(F.lit(1)).alias("size"))
    meeting = shown.groupBy(*PIXEL).agg(F.sort_array(F.collect_set("ord")).alias("o")).filter(F.size("o") > 1)
    pairs = F.expr(
        "flatten(transform(o, (a, i) -> transform(slice(o, i + 2, size(o)), b -> named_struct('first_ord', a, 'second_ord', b))))"
    )
    shared = (
        meeting.select("sample_id", F.explode(pairs).alias("p"))
        .groupBy("sample_id", "p.first_ord", "p.second_ord")
        .agg(F.count(F.lit(1)).alias("shared_pixels"))
    )
    first = sizes.select("sample_id", F.col("ord").alias("first_ord"), F.col("size").alias("_a"))
    second = sizes.select("sample_id", F.col("ord").alias("second_ord"), F.col("size").alias("_b"))
    return (
        shared.join(first, ["sample_id", "first_ord"])
        .join(second, ["sample_id", "second_ord"])
        .select(
            "sample_id", "first_ord", "second_ord", "shared_pixels",
            (F.col("shared_pixels") / F.greatest(F.least("_a", "_b"), F.lit(1))).alias("fraction"),
        )
    )


def edit_overlap(layers: DataFrame, limit: float = arrays.MAX_OVERLAP) -> DataFrame:
    return overlap_fractions(layers).filter(F.col("fraction") > limit)


def removal_violations(pixels: DataFrame) -> DataFrame:
    """Samples whose removal changed too little, or anything outside its mask.

    ``pixels`` has ``target``, ``removed`` and the boolean ``edit``.
    """
    moved = changed([F.col("target")], [F.col("removed")])
    return _flagged(
        pixels,
        {
            "removal_ineffective": F.count_if(moved) < arrays.MIN_CHANGED,
            "removal_outside_mask": F.count_if(moved & ~F.col("edit")) > 0,
        },
    )


def insertion_violations(pixels: DataFrame) -> DataFrame:
    """Samples whose insertion changed too little, or pixels neither removed nor covered.

    ``pixels`` has ``target``, ``removed``, ``inserted`` and the booleans ``edit``
    (removal mask) and ``covered`` (some layer's alpha is above zero).
    """
    moved = changed([F.col("removed")], [F.col("inserted")])
    differs = changed([F.col("target")], [F.col("inserted")])
    return _flagged(
        pixels,
        {
            "insertion_ineffective": F.count_if(moved) < arrays.MIN_CHANGED,
            "changed_outside_support": F.count_if(differs & ~(F.col("edit") | F.col("covered"))) > 0,
        },
    )


def _flagged(pixels: DataFrame, rules: dict[str, Column]) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()]))
    return pixels.groupBy("sample_id").agg(found.alias("codes")).filter(F.size("codes") > 0)


def pack(pixels: DataFrame, keys: list[str], byte: str) -> DataFrame:
    """Pixels of one image, row by row, as a binary column. An image has a fixed size."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("y", "x", F.col(byte).alias("b")))), lambda p: p["b"])
    return pixels.groupBy(*keys).agg(ordered.alias("_b")).select(
        *keys, F.unhex(F.array_join(F.transform("_b", lambda b: F.lpad(F.hex(b), 2, "0")), "")).alias("image")
    )


# --- whole images --------------------------------------------------------


def decode_pixels(images: DataFrame) -> DataFrame:
    """Raw RGB or grey bytes from decoded images, with codes for wrong size or mode.

    The image source stores channels as blue, green, red.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flipped = [
                np.frombuffer(data, np.uint8).reshape(-1, 3)[:, ::-1].tobytes() if channels == 3 else data
                for data, channels in zip(batch["data"], batch["channels"])
            ]
            yield batch[["path", "width", "height", "channels"]].assign(pixels=flipped)

    good = images.filter(F.col("height") > 0).select("path", "width", "height", "channels", "data")
    return good.mapInPandas(run, "path STRING, width INT, height INT, channels INT, pixels BINARY")


_DECODED = pa.struct([("width", pa.int32()), ("height", pa.int32()), ("channels", pa.int32()), ("pixels", pa.binary()), ("code", pa.string())])


def decode_png_column(files: DataFrame, content: str = "content") -> DataFrame:
    """width, height, channels, pixels and code of PNG bytes that any table holds in ``content``.

    Channels are in file order. A row whose bytes can't be read has a code and no pixels;
    other columns stay, and columns named as the new ones are replaced.
    """
    kept = [c for c in files.columns if c not in _DECODED.names]
    return with_kernel(files.select(*kept), "_decoded", _DECODED, [content], lambda row: png.decode(row[content])).select(
        *[c for c in kept if c != content], "_decoded.*"
    )


def components(masks: DataFrame, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH) -> DataFrame:
    """Components of every mask with their sizes; ``mask`` is one byte per pixel, above zero is set."""
    keys = [c for c in masks.columns if c != "mask"]
    schema = ", ".join(f"{c} {masks.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                labels = arrays.label_components(np.frombuffer(row.mask, np.uint8).reshape(height, width) > 0).ravel()
                for i, first, size in zip(*np.unique(labels, return_index=True, return_counts=True)):
                    if i:
                        found.append([*(getattr(row, k) for k in keys), int(i), int(size), int(first)])
            yield pd.DataFrame(found, columns=[*keys, "component_index", "component_pixels", "first_pixel"])

    return masks.mapInPandas(run, schema + ", component_index INT, component_pixels INT, first_pixel INT")


_COUNT_FACTS = (
    "full_projected_pixels", "minimum_overlap_pixels", "selected_occlusion_pixels", "renderer_verified_occlusion_pixels",
    "restored_asset_pixels", "target_exact_overlap_pixels",
)
_HASH_FACTS = ("full_asset_support_sha256", "target_exact_support_sha256", "nearer_depth_support_sha256", "selected_occlusion_mask_sha256")
_COMPONENT = pa.struct(
    [("component_index", pa.int32()), ("component_pixels", pa.int32()), ("verified_nearer_seed_pixels", pa.int32()), ("accepted", pa.bool_())]
)
_EVIDENCE = pa.struct(
    [("depth_code", pa.string()), ("median_depth_m", pa.float64()), ("foreground", pa.binary()), ("components", pa.list_(_COMPONENT))]
    + [("target_center_depth_m", pa.float64()), ("selected_occlusion_fraction", pa.float64())]
    + [(n, pa.int32()) for n in _COUNT_FACTS]
    + [(n, pa.string()) for n in _HASH_FACTS]
)


def _ddl(kind: pa.DataType) -> str:
    """Spark's name of an Arrow type."""
    if pa.types.is_struct(kind):
        return f"STRUCT<{', '.join(f'{f.name}: {_ddl(f.type)}' for f in kind)}>"
    if pa.types.is_list(kind):
        return f"ARRAY<{_ddl(kind.value_type)}>"
    names = {pa.string(): "STRING", pa.binary(): "BINARY", pa.bool_(): "BOOLEAN", pa.int32(): "INT", pa.int64(): "BIGINT", pa.float64(): "DOUBLE"}
    return names[kind]


def with_kernel(df: DataFrame, name: str, kind: pa.StructType, columns: list[str], kernel: Callable[[dict], dict]) -> DataFrame:
    """``df`` with a struct that ``kernel`` makes of the named columns of each row.

    All columns of ``df`` go through as they are, so rows with images are not joined
    to their results: there is no exchange, and one Python stage for each kernel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [kernel(row) for row in batch.select(columns).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, kind)], names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructType.fromDDL(f"`{name}` {_ddl(kind)}")[0]]))


def occlusion_receipts(layers: DataFrame, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH) -> DataFrame:
    """Layers with their median depth and, where occlusion is material and proven, its evidence.

    ``layers`` has the byte masks ``full_alpha``, ``visible_alpha`` and ``exact_alpha``,
    and the float64 depth maps ``scene_depth`` and ``asset_depth``; its other columns
    stay. ``depth_code`` tells layers without any positive finite depth and, where pixels
    are hidden, maps of a wrong shape.
    """

    def one(row: dict) -> dict:
        full, visible, exact = (
            np.frombuffer(row[m], np.uint8).reshape(height, width) > arrays.ADAPTER_BYTE for m in ("full_alpha", "visible_alpha", "exact_alpha")
        )
        scene, asset = (np.frombuffer(row[d], np.float64) for d in ("scene_depth", "asset_depth"))
        hidden = (full & ~visible).any()
        if hidden and (scene.size != full.size or asset.size != full.size):
            return {"depth_code": "depth_shape_differs"}
        median = arrays.median_depth(asset)
        if median is None:
            return {"depth_code": "no_positive_depth"}
        found = {"median_depth_m": median}
        if not hidden:
            return found
        shape = (height, width)
        evidence = arrays.occlusion_evidence(full, visible, exact, scene.reshape(shape), asset.reshape(shape)) or {}
        if evidence and evidence["target_center_depth_m"] is None:
            return found | {"depth_code": "no_positive_support"}
        return found | evidence

    needed = ["full_alpha", "visible_alpha", "exact_alpha", "scene_depth", "asset_depth"]
    kept = [c for c in layers.columns if c not in _EVIDENCE.names]
    return with_kernel(layers.select(*kept), "_evidence", _EVIDENCE, needed, one).select(*kept, "_evidence.*")


def receipt_struct(layers: DataFrame, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH) -> Column:
    """Signed occlusion receipt in the form the gates read, for the rows of :func:`occlusion_receipts`.

    ``instance_token`` is the layer's target; rows without evidence have no receipt.
    """
    region = F.struct(
        F.lit(0).alias("ordinal"),
        F.lit(STATIC_EVIDENCE).alias("evidence_kind"),
        F.lit(STATIC_REGION).alias("region_id"),
        F.lit(arrays.MIN_SEEDS).alias("minimum_verified_seed_pixels_per_component"),
        F.col("components"),
        F.transform(F.filter("components", lambda c: c["accepted"]), lambda c: c["component_index"]).alias(
            "accepted_component_indices"
        ),
        F.col("selected_occlusion_pixels").alias("selected_pixels"),
        F.lit(True).alias("accepted"),
    )
    body = F.struct(
        F.lit(1).alias("schema_version"),
        F.lit(OCCLUSION_POLICY).alias("policy"),
        F.col("instance_token").alias("target_instance_token"),
        "target_center_depth_m",
        F.lit(arrays.DEPTH_MARGIN_M).alias("absolute_depth_margin_m"),
        F.lit(arrays.DEPTH_MARGIN_SHARE).alias("relative_depth_margin"),
        F.lit(arrays.MIN_SEEDS).alias("minimum_static_seed_pixels"),
        F.array(F.lit(height), F.lit(width)).alias("image_shape_hw"),
        F.sha2("scene_depth", 256).alias("scene_depth_sha256"),
        F.sha2("asset_depth", 256).alias("asset_depth_sha256"),
        F.array()
        .cast(
            "array<struct<is_distinct_from_target: boolean, official_annotation_bound: boolean, "
            "strictly_nearer_than_target: boolean, accepted: boolean>>"
        )
        .alias("official_instance_decisions"),
        F.array(region).alias("static_region_decisions"),
        F.lit(True).alias("target_exact_is_diagnostic_only"),
        F.lit(True).alias("quality_gate_pass"),
        F.lit(True).alias("independent_foreground_verified"),
        "selected_occlusion_fraction",
        *_COUNT_FACTS,
        *_HASH_FACTS,
    )
    return signed(layers, F.when(F.col("foreground").isNotNull(), body))


_REMOVAL = pa.struct([("removed", pa.binary()), ("removed_mask", pa.binary())])


def merge_removals(samples: DataFrame, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH) -> DataFrame:
    """Samples with their removed image and union mask, ``removed`` and ``removed_mask``.

    ``samples`` has the RGB bytes ``target`` and ``edits``, an array of (mask,
    replacement) in layer order; later layers win. Other columns stay.
    """

    def one(row: dict) -> dict:
        image = np.frombuffer(row["target"], np.uint8).reshape(height * width, 3).copy()
        union = np.zeros(height * width, dtype=bool)
        for edit in row["edits"]:
            mask = np.frombuffer(edit["mask"], np.uint8) > arrays.ADAPTER_BYTE
            image[mask] = np.frombuffer(edit["replacement"], np.uint8).reshape(-1, 3)[mask]
            union |= mask
        return {"removed": image.tobytes(), "removed_mask": (union * np.uint8(255)).tobytes()}

    kept = [c for c in samples.columns if c not in _REMOVAL.names]
    return with_kernel(samples.select(*kept), "_removal", _REMOVAL, ["target", "edits"], one).select(*kept, "_removal.*")


def _shas(**columns: Column | str) -> Column:
    """Struct of the hashes of binary columns."""
    return F.struct(*[F.sha2(F.col(c) if isinstance(c, str) else c, 256).alias(name) for name, c in columns.items()])


def adapt_results(jobs: DataFrame, layers: DataFrame, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH) -> DataFrame:
    """Renderer layers of each job as one result row, ready for :func:`compose`.

    ``jobs`` holds what a result repeats of its job and exposure; ``layers`` has
    one row per (sample, ord) with masks, depth maps, images, the nested
    ``raw_quality``, the cleanup flags and ``cleanup_decision_sha256``. A job has a
    handful of layers. Receipts carry their own hashes, and the result the hashes of all
    its images. Layer images are moved once, to their sample.
    """
    found = occlusion_receipts(layers, height, width)
    occluded = F.coalesce(F.col("selected_occlusion_pixels") > 0, F.lit(False))
    layer = F.struct(
        "ord",
        F.struct(
            "obj_id", "instance_token", "asset_sha256", "exact_identity_verified", "official_dimensions_m", "forward_axis",
            "official_dimensions_applied", "canonical_orientation_applied", "bottom_ground_locked", "median_depth_m",
            normalize_quality(F.col("raw_quality"), occluded).alias("quality"),
            F.col("layer_rgb").alias("rgb"), F.col("full_alpha").alias("alpha"),
            "foreground",
            F.col("exact_alpha").alias("exact"),
            _shas(rgb="layer_rgb", alpha="full_alpha", foreground="foreground", exact="exact_alpha").alias("content_sha256"),
            receipt_struct(found, height, width).alias("receipt"),
        ).alias("layer"),
    )

    def in_order(value: Column) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct("ord", value.alias("e")))), lambda v: v["e"])

    per_sample = found.groupBy("sample_id").agg(
        in_order(F.struct("mask", "replacement")).alias("edits"),
        F.array_agg(layer).alias("_layers"),
        F.max("depth_code").alias("depth_code"),
        cleanup_receipt(
            F.bool_and(F.coalesce("usable", F.lit(False))), F.bool_and(F.coalesce("passed", F.lit(False))), in_order(F.col("cleanup_decision_sha256"))
        ).alias("_cleanup"),
        F.min("target_sha256").eqNullSafe(F.max("target_sha256")).alias("same_target"),
        F.min("gt_sha256").eqNullSafe(F.max("gt_sha256")).alias("same_gt"),
    )
    whole = merge_removals(jobs.join(per_sample, "sample_id"), height, width)
    return whole.select(
        *[c for c in jobs.columns],
        F.when(F.col("depth_code").isNotNull(), F.col("depth_code"))
        .when(~(F.col("same_target") & F.col("same_gt")), "backgrounds_differ")
        .alias("adapter_code"),
        signed(whole, F.col("_cleanup")).alias("original_actor_cleanup_receipt"),
        "removed",
        "removed_mask",
        _shas(gt="gt", target="target", removed="removed", removed_mask="removed_mask").alias("source_sha256"),
        F.expr("transform(array_sort(_layers, (a, b) -> a.ord - b.ord), v -> v.layer)").alias("asset_layers"),
    )


_LAYER_FACTS = pa.struct(
    [("support", pa.int64()), ("occluded", pa.int64()), ("seen", pa.int64())]
    + [(n, pa.string()) for n in ("support_sha256", "occluded_sha256", "exact_sha256")]
)
_FACTS = pa.struct(
    [("valid", pa.bool_()), ("moved", pa.int64()), ("moved_outside", pa.bool_()), ("layers", pa.list_(_LAYER_FACTS))]
    + [("overlapping", pa.bool_()), ("inserted", pa.int64()), ("inserted_outside", pa.bool_()), ("input", pa.binary())]
)


def paint_samples(samples: DataFrame, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH) -> DataFrame:
    """Samples with ``facts``: the painted image and what the pixel rules count.

    ``samples`` has the RGB bytes ``target`` and ``removed``, the mask ``removed_mask``,
    and ``asset_layers`` with ``rgb``, ``alpha``, ``foreground``, ``exact`` and
    ``median_depth_m``; other columns stay. The kernel decides nothing but what the
    picture needs: occlusion below the least material size is none.
    """
    size = height * width

    def rgb(data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.uint8).reshape(height, width, 3).astype(np.float32) / np.float32(255)

    def grey(data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.uint8).reshape(height, width).astype(np.float32) / np.float32(255)

    def one(row: dict) -> dict:
        layers = row["asset_layers"] or []
        parts = [row["target"], row["removed"]] + [x["rgb"] for x in layers]
        masks = [row["removed_mask"]] + [x["alpha"] for x in layers]
        masks += [x[m] for x in layers for m in ("foreground", "exact") if x[m] is not None]
        if any(p is None or len(p) != 3 * size for p in parts) or any(m is None or len(m) != size for m in masks):
            return {"valid": False}
        target, removed, edit = rgb(row["target"]), rgb(row["removed"]), grey(row["removed_mask"]) > 0
        moved = arrays.changed(removed, target)
        out = {"valid": True, "moved": int(moved.sum()), "moved_outside": bool((moved & ~edit).any()), "layers": []}
        alphas, colours, depths = [], [], []
        for x in layers:
            alpha = grey(x["alpha"])
            support = alpha > arrays.SUPPORT
            hidden = np.zeros_like(support) if x["foreground"] is None else (grey(x["foreground"]) >= arrays.OCCLUDER) & support
            if hidden.sum() < arrays.least_material(int(support.sum())):
                hidden[:] = False
            alpha = np.where(hidden, np.float32(0), alpha)
            out["layers"].append(
                {
                    "support": int(support.sum()), "occluded": int(hidden.sum()), "seen": int((alpha > arrays.SUPPORT).sum()),
                    "support_sha256": arrays.mask_sha(support), "occluded_sha256": arrays.mask_sha(hidden),
                    "exact_sha256": None if x["exact"] is None else arrays.mask_sha(grey(x["exact"]) > arrays.SUPPORT),
                }
            )
            alphas.append(alpha)
            colours.append(np.where(hidden[..., None], np.float32(0), rgb(x["rgb"])))
            depths.append(float(x["median_depth_m"] or np.inf))
        if not layers:
            return out
        stack = np.stack(alphas)
        done = arrays.paint(removed, np.stack(colours), stack, np.array(depths))
        return out | {
            "overlapping": arrays.overlap_exceeded(stack > arrays.SUPPORT),
            "inserted": int(arrays.changed(done, removed).sum()),
            "inserted_outside": bool((arrays.changed(done, target) & ~(edit | (stack > 0).any(axis=0))).any()),
            "input": arrays.to_bytes(done),
        }

    return with_kernel(samples, "facts", _FACTS, ["target", "removed", "removed_mask", "asset_layers"], one)


def layer_occlusion(layer: Column, facts: Column) -> Column:
    """pixels, applied and renderer_occlusion_regression of one painted layer."""
    receipt, pixels, support = layer["receipt"], facts["occluded"], facts["support"]
    masked = layer["foreground"].isNotNull()
    return F.struct(
        pixels.cast("int").alias("pixels"),
        (masked & occlusion_applied(pixels, support)).alias("applied"),
        (masked & occlusion_regression(receipt["renderer_verified_occlusion_pixels"], receipt["restored_asset_pixels"], pixels, support)).alias(
            "renderer_occlusion_regression"
        ),
    )


def layer_pixel_violations(layer: Column, facts: Column) -> Column:
    """Codes of one painted layer: does its receipt fit its masks, and is enough of it seen?"""
    receipt = layer["receipt"]
    versioned = layer["foreground"].isNotNull() & receipt["schema_version"].isNotNull()
    same = lambda claimed, counted: F.coalesce(claimed == counted, F.lit(False))
    fits = (
        same(receipt["full_asset_support_sha256"], facts["support_sha256"])
        & same(receipt["selected_occlusion_mask_sha256"], facts["occluded_sha256"])
        & (layer["exact"].isNull() | same(receipt["target_exact_support_sha256"], facts["exact_sha256"]))
    )
    counted = value_or(receipt["selected_occlusion_pixels"], 0) == facts["occluded"]
    return codes(
        {
            "occlusion_pixels_differ": versioned & ~counted,
            "occlusion_support_differs": versioned & counted & ~fits,
            "occlusion_regression": layer_occlusion(layer, facts)["renderer_occlusion_regression"],
            "not_materially_visible": ~visible_enough(facts["seen"], layer["quality"]["complete_projected_asset_pixels"]),
        }
    )


def sample_pixel_violations(layers: Column, facts: Column) -> Column:
    """Codes of one painted sample, in the order of the stages; an invalid image has no others."""
    removal = codes(
        {
            "removal_ineffective": facts["moved"] < arrays.MIN_CHANGED,
            "removal_outside_mask": facts["moved_outside"],
            "no_asset_layers": F.size(facts["layers"]) == 0,
        }
    )
    each = F.flatten(F.zip_with(layers, facts["layers"], layer_pixel_violations))
    insertion = codes(
        {
            "edit_overlap": is_true(facts["overlapping"]),
            "insertion_ineffective": F.coalesce(facts["inserted"] < arrays.MIN_CHANGED, F.lit(False)),
            "changed_outside_support": is_true(facts["inserted_outside"]),
        }
    )
    return F.when(~facts["valid"], F.array(F.lit("invalid_image"))).otherwise(F.concat(removal, F.coalesce(each, F.array()), insertion))


def hash_violations(names: dict[str, Column], declared: Column, code: str) -> Column:
    """``code`` where a declared hash is none or differs from the bytes; absent optional bytes are passed as null."""
    wrong = [data.isNotNull() & (~is_hash(declared[n]) | (declared[n] != F.sha2(data, 256))) for n, data in names.items()]
    return F.array_compact(F.array(F.when(F.coalesce(reduce(or_, wrong), F.lit(True)), F.lit(code))))


def compose(
    results: DataFrame, expected_domain: str, order: str = "ord", height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH
) -> tuple[DataFrame, DataFrame]:
    """Accepted triplets and rejected results with a reason.

    The rule gates run first, as columns; only rows that pass them are painted. The
    reason is the first rule broken; a fault that :func:`adapt_results` found in
    ``adapter_code`` comes before all others. An id is taken by its first complete row in
    ``order``, whether or not that row passes. Cleanup and occlusion receipts must carry
    their own hash in ``decision_sha256``, and ``source_sha256`` and the layers'
    ``content_sha256`` must be the hashes of the bytes.

    Rows with images are dealt by sample_id once, or not at all where they are already.
    """
    kind = results.schema
    complete = (text(F.col("status")) == "complete") & (text(F.col("sample_id")) != "")
    owners = results.filter(complete).groupBy("sample_id").agg(F.min(order).alias("_owner"))
    body = F.struct(*results.columns)
    layers = F.coalesce("asset_layers", F.array())
    layer_kind = kind["asset_layers"].dataType.elementType
    adapter = F.array_compact(F.array(F.col("adapter_code"))) if "adapter_code" in results.columns else F.array().cast("array<string>")

    def layer_hashes(x: Column) -> Column:
        return hash_violations({n: x[n] for n in ("rgb", "alpha", "foreground", "exact")}, x["content_sha256"], "layer_hash_mismatch")

    def receipts(x: Column) -> Column:
        found = receipt_violations(x["receipt"], layer_kind["receipt"].dataType)
        return F.when(x["foreground"].isNotNull(), found).otherwise(F.array().cast("array<string>"))

    ruled = F.concat(
        adapter,
        result_violations(body, kind, F.lit(expected_domain)),
        hash_violations({n: F.col(n) for n in ("gt", "target", "removed", "removed_mask")}, F.col("source_sha256"), "source_hash_mismatch"),
        F.flatten(F.transform(layers, lambda x: F.concat(layer_violations(x), layer_hashes(x), receipts(x)))),
    )
    claimed = F.when(complete & (F.col(order) != F.col("_owner")), F.array(F.lit("duplicate_result"))).otherwise(F.array().cast("array<string>"))
    judged = results.join(owners, "sample_id", "left").withColumn("_codes", F.concat(claimed, ruled)).drop("_owner")
    painted = paint_samples(judged.filter(F.size("_codes") == 0).drop("_codes"), height, width)
    painted = painted.withColumn("_codes", sample_pixel_violations(F.col("asset_layers"), F.col("facts")))

    def refused(rows: DataFrame) -> DataFrame:
        return rows.filter(F.size("_codes") > 0).select("sample_id", order, F.get("_codes", F.lit(0)).alias("reason"))

    noted = F.zip_with(
        "asset_layers", "facts.layers",
        lambda x, f: F.struct(
            x["obj_id"].alias("obj_id"),
            x["instance_token"].alias("instance_token"),
            x["asset_sha256"].alias("asset_sha256"),
            x["official_dimensions_m"].alias("official_dimensions_m"),
            x["forward_axis"].alias("forward_axis"),
            nonzero_or(x["median_depth_m"], float("inf")).alias("median_depth_m"),
            x["quality"].alias("quality"),
            layer_occlusion(x, f).alias("occlusion"),
        ),
    )
    accepted = painted.filter(F.size("_codes") == 0).select(
        "sample_id", order, "scene_name", "frame_index", "camera_id",
        F.transform("asset_layers", lambda x: x["obj_id"]).alias("selected_obj_ids"),
        noted.alias("asset_layers"),
        "gt",
        F.col("facts.input").alias("input"),
        "target",
        _shas(gt="gt", input="facts.input", target="target").alias("content_sha256"),
    )
    return accepted, refused(judged).unionByName(refused(painted))


def attach_images(wanted: DataFrame, images: DataFrame) -> DataFrame:
    """Bytes for each wanted (owner, slot, path), with a code where the file is absent or differs.

    ``wanted`` has ``owner``, ``slot``, ``path`` and the declared ``sha256``;
    ``images`` has ``path``, ``sha256`` and ``pixels``.
    """
    found = images.select("path", F.col("sha256").alias("_sha"), "pixels")
    return wanted.join(found, "path", "left").select(
        "owner",
        "slot",
        "path",
        "pixels",
        F.when(F.col("_sha").isNull(), "missing_file")
        .when(~is_hash(F.col("sha256")) | (F.col("sha256") != F.col("_sha")), "source_hash_mismatch")
        .alias("code"),
    )
