"""From assets and observations to render jobs for single assets and combinations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from pairgrid.functions.gates import dimensions_ok
from pairgrid.functions.hashing import canonical_json, canonical_sha
from pairgrid.functions.semantics import (
    CAMERAS,
    FORWARD_AXIS,
    blank,
    codes,
    first_text,
    frame_name,
    is_hash,
    key_violations,
    lwh_from_wlh,
    require_empty,
    sorted_set,
    split_view_key,
    text,
    value_or,
    window_name,
)
from pairgrid.session import staged

WINDOW = ["scene_name", "window_id"]
CELL = ["scene_name", "window_id", "frame_index", "camera_id"]

# Selections that are numbered and decoded together.
_FOLD = 4096
# Objects in one long of a mask.
_WORD = 63


def field(df: DataFrame, path: str, kind: str) -> Column:
    """A possibly nested column, or a typed null when the table lacks it."""
    at: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(at, T.StructType) or part not in at.fieldNames():
            return F.lit(None).cast(kind)
        at = at[part].dataType
    return F.col(path).cast(kind)


# --- assets --------------------------------------------------------------


def normalize_assets(df: DataFrame, root: str = "") -> DataFrame:
    """Asset bindings from either manifest shape; relative paths are put below ``root``."""

    def some(c: Column) -> Column:
        return F.when(F.size(c) > 0, c)

    path = first_text(field(df, "ply_path", "string"), field(df, "asset_path", "string"))
    if root:
        path = F.when(path.startswith("/") | path.contains("://"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
    return df.select(
        first_text(field(df, "asset_id", "string"), field(df, "global_uid", "string")).alias("asset_id"),
        text(field(df, "obj_id", "string")).alias("obj_id"),
        text(field(df, "instance_token", "string")).alias("instance_token"),
        text(field(df, "category", "string")).alias("category"),
        path.alias("ply_path"),
        first_text(
            field(df, "ply_sha256", "string"),
            field(df, "asset_sha256", "string"),
            field(df, "canonical.canonical_asset_sha256", "string"),
        ).alias("ply_sha256"),
        F.coalesce(
            some(field(df, "dimensions_m", "array<double>")),
            field(df, "size_xyz", "array<double>"),
            F.array().cast("array<double>"),
        ).alias("dimensions_m"),
        first_text(field(df, "forward_axis", "string"), field(df, "canonical.front_axis", "string")).alias("forward_axis"),
    )


def asset_violations(assets: DataFrame) -> DataFrame:
    """Assets that break the binding contract, with codes."""
    missing = F.lit(False)
    for c in ("asset_id", "obj_id", "instance_token", "category"):
        missing = missing | blank(F.col(c))
    return assets.select(
        "asset_id",
        "obj_id",
        codes(
            {
                "incomplete_identity": missing,
                "invalid_dimensions": ~dimensions_ok(F.col("dimensions_m")),
                "wrong_forward_axis": text(F.col("forward_axis")) != FORWARD_AXIS,
                "invalid_asset_hash": ~is_hash(F.col("ply_sha256")),
            }
        ).alias("codes"),
    ).filter(F.size("codes") > 0)


def asset_row_id(df: DataFrame) -> Column:
    return first_text(*[field(df, c, "string") for c in ("obj_id", "global_uid", "asset_id")])


def exclude_assets(assets: DataFrame, exclusions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assets without the excluded ones, and the exclusions that are empty or unknown.

    ``exclusions`` has one column ``excluded_id``.
    """
    wanted = exclusions.select(text(F.col("excluded_id")).alias("excluded_id")).distinct()
    ids = assets.select(asset_row_id(assets).alias("excluded_id")).distinct()
    kept = assets.withColumn("_id", asset_row_id(assets)).join(
        wanted.withColumnRenamed("excluded_id", "_id"), "_id", "left_anti"
    )
    unknown = wanted.join(ids.filter(~blank(F.col("excluded_id"))), "excluded_id", "left_anti")
    return kept.drop("_id"), unknown


def verify_assets(assets: DataFrame, files: DataFrame) -> DataFrame:
    """Assets whose file is absent or differs; ``files`` has ``path`` and ``sha256``."""
    return (
        assets.select("asset_id", F.col("ply_path").alias("path"), "ply_sha256")
        .join(files.select("path", "sha256"), "path", "left")
        .select(
            "asset_id",
            "path",
            F.when(F.col("sha256").isNull(), "missing_file").when(F.col("sha256") != F.col("ply_sha256"), "hash_mismatch").alias(
                "code"
            ),
        )
        .filter(F.col("code").isNotNull())
    )


# --- observations --------------------------------------------------------


def window_violations(windows: DataFrame) -> DataFrame:
    """Capacity rows whose temporal window is not well formed."""

    def strictly_rising(c: str) -> Column:
        return F.coalesce((F.size(c) > 0) & (F.col(c) == sorted_set(F.col(c))), F.lit(False))

    start = F.coalesce(F.col("context_start") == F.get("context_frames", F.lit(0)), F.lit(False))
    return windows.select(
        "scene_name",
        "context_start",
        codes(
            {
                "no_scene": blank(F.col("scene_name")),
                "invalid_context_frames": ~strictly_rising("context_frames"),
                "invalid_target_frames": ~strictly_rising("target_frames"),
                "context_start_mismatch": ~start,
            }
        ).alias("codes"),
    ).filter(F.size("codes") > 0)


def flatten_capacity(windows: DataFrame) -> DataFrame:
    """Observations from capacity rows: one per candidate and visible view key.

    A candidate without keys uses its own target frame and camera.
    """
    inner = windows.schema["candidates"].dataType.elementType.fieldNames()

    def c(name: str, kind: str) -> Column:
        return F.col(f"c.{name}").cast(kind) if name in inner else F.lit(None).cast(kind)

    keys = c("visible_target_frame_camera_keys", "array<string>")
    own = F.array(F.format_string("%06d:c%s", value_or(c("target_frame", "int"), -1), c("camera_id", "string")))
    frame, camera = split_view_key(F.col("k"))
    return (
        windows.select("scene_name", "context_start", F.explode("candidates").alias("c"))
        .select("*", F.explode(F.when(F.size(keys) > 0, keys).otherwise(own)).alias("k"))
        .select(
            "scene_name",
            window_name(value_or(F.col("context_start"), 0)).alias("window_id"),
            frame.alias("frame_index"),
            F.col("c.obj_id").alias("obj_id"),
            F.col("c.instance_token").alias("instance_token"),
            value_or(c("projected_area_native_pixels", "long"), 0).alias("area_pixels"),
            value_or(c("visibility_token", "int"), 0).alias("visibility_level"),
            F.array(camera).alias("visible_cameras"),
            lwh_from_wlh(c("official_size_wlh_m", "array<double>")).alias("official_dimensions_m"),
            F.coalesce(c("review_images", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("review_images"),
        )
    )


def camera_list(listed: Column | None, observed: Column | None) -> Column:
    """Sorted distinct cameras: the list wins, even empty, over the map of flags."""
    from_map = F.map_keys(F.map_filter(observed, lambda k, v: F.coalesce(v, F.lit(False)))) if observed is not None else None
    found = [c for c in (listed, from_map) if c is not None]
    chosen = F.coalesce(*found, F.array().cast("array<string>"))
    return sorted_set(F.transform(chosen, lambda c: F.regexp_replace(c, "^c", "")))


def camera_violations(cameras: Column) -> Column:
    return F.exists(cameras, lambda c: ~F.coalesce(c, F.lit("")).isin(*CAMERAS))


def eligible_observations(obs: DataFrame, min_area: int = 30, min_visibility: int = 2) -> DataFrame:
    return obs.filter(
        (value_or(F.col("area_pixels"), 0) >= min_area) & (value_or(F.col("visibility_level"), 0) >= min_visibility)
    )


def bind_assets(obs: DataFrame, assets: DataFrame) -> DataFrame:
    """Observations of known assets with their binding; unknown assets drop out.

    ``token_differs`` marks an instance token that contradicts the binding. No
    broadcast is forced: the asset table grows with the data, so its size decides.
    """
    bound = assets.select(
        "obj_id",
        "asset_id",
        F.col("instance_token").alias("_token"),
        "category",
        F.col("ply_path").alias("asset_path"),
        F.col("ply_sha256").alias("asset_sha256"),
        "dimensions_m",
        "forward_axis",
    )
    return (
        obs.join(bound, "obj_id")
        .withColumn("token_differs", text(F.col("instance_token")) != F.col("_token"))
        .withColumn("instance_token", F.col("_token"))
        .drop("_token")
    )


# Review image labels and the identity fields they come from.
IDENTITY_IMAGES = {
    "identity_sheet": "review_sheet",
    "source": "source_raw_image",
    "canonical_views": "ply_evidence",
    "canonical_heading": "heading_evidence",
}
# The identity field which declares the hash of a labelled image.
IDENTITY_HASHES = {
    "identity_sheet": "review_sheet_sha256",
    "source": "source_sha256",
    "canonical_views": "ply_evidence_sha256",
    "canonical_heading": "heading_evidence_sha256",
}


def bind_identity(bound: DataFrame, identity: DataFrame) -> DataFrame:
    """Attach identity evidence; ``identity_code`` names what is wrong with it."""
    evidence = identity.select("obj_id", F.struct(*identity.columns).alias("identity"))
    row = F.col("identity")
    return bound.join(evidence, "obj_id", "left").withColumn(
        "identity_code",
        F.when(row.isNull(), "missing_identity").when(
            (text(row["instance_token"]) != F.col("instance_token"))
            | (text(row["category"]) != F.col("category"))
            | (text(row["canonical_asset_sha256"]) != F.col("asset_sha256")),
            "identity_differs",
        ),
    )


def review_evidence(bound: DataFrame) -> DataFrame:
    """Fill ``review_images`` from the identity row where an observation has none."""
    given = F.col("review_images") if "review_images" in bound.columns else F.create_map().cast("map<string,string>")
    own = F.create_map().cast("map<string,string>")
    if "identity" in bound.columns:
        names = bound.schema["identity"].dataType.fieldNames()
        labels = [(label, name) for label, name in IDENTITY_IMAGES.items() if name in names]
        own = F.map_filter(
            F.map_from_arrays(F.array(*[F.lit(x) for x, _ in labels]), F.array(*[F.col(f"identity.{n}") for _, n in labels])),
            lambda k, v: ~blank(v),
        )
    return bound.withColumn("review_images", F.when(F.size(given) > 0, given).otherwise(own))


def evidence_violations(evidence: DataFrame, files: DataFrame) -> DataFrame:
    """Review images that are absent or differ from the hash their identity row declares."""
    names = evidence.schema["identity"].dataType.fieldNames() if "identity" in evidence.columns else []
    declared = F.lit(None).cast("string")
    for label in IDENTITY_IMAGES:
        if IDENTITY_HASHES[label] in names:
            declared = F.when(F.col("label") == label, F.col(f"identity.{IDENTITY_HASHES[label]}")).otherwise(declared)
    opened = evidence.select("obj_id", *(["identity"] if names else []), F.explode("review_images").alias("label", "path"))
    return (
        opened.select("obj_id", "label", "path", declared.alias("declared"))
        .distinct()
        .join(files.select("path", "sha256"), "path", "left")
        .select(
            "obj_id",
            "label",
            F.when(F.col("sha256").isNull(), "missing_file")
            .when(~blank(F.col("declared")) & (F.col("declared") != F.col("sha256")), "hash_mismatch")
            .alias("code"),
        )
        .filter(F.col("code").isNotNull())
    )


def duplicate_observations(jobs: DataFrame) -> DataFrame:
    return key_violations(jobs, [*CELL, "obj_id"])


# --- jobs ----------------------------------------------------------------


def job_sha() -> Column:
    """Hash of a job's content, with dimensions as text."""
    asset = F.transform(
        "assets",
        lambda a: F.struct(
            a["asset_id"].alias("asset_id"),
            a["asset_sha256"].alias("asset_sha256"),
            F.transform(a["official_dimensions_m"], lambda v: v.cast("string")).alias("official_dimensions_m"),
        ),
    )
    return canonical_sha(F.struct(asset.alias("assets"), "camera_id", "frame_index", "sample_id", "scene_name", "window_id"))


def to_jobs(evidence: DataFrame) -> DataFrame:
    """One single-asset job per observation and visible camera.

    Ids use the first 12 characters of the asset id; uniqueness is for
    ``key_violations`` to check.
    """
    columns = evidence.columns
    official = F.col("official_dimensions_m") if "official_dimensions_m" in columns else F.array().cast("array<double>")
    listed = F.col("visible_cameras") if "visible_cameras" in columns else None
    observed = F.col("camera_observations") if "camera_observations" in columns else None
    frame = F.col("frame_index")
    window = first_text(F.col("window_id"), window_name(frame)) if "window_id" in columns else window_name(frame)
    asset = F.struct(
        "asset_id", "obj_id", "instance_token", "category", "asset_path", "asset_sha256",
        F.when(F.size(official) > 0, official).otherwise(F.col("dimensions_m")).alias("official_dimensions_m"),
        "forward_axis",
    )
    return (
        evidence.withColumn("window_id", window)
        .select(
            "scene_name", "window_id", "frame_index", "obj_id", "review_images", asset.alias("asset"),
            F.explode(camera_list(listed, observed)).alias("camera_id"),
        )
        .select(
            F.concat_ws(
                "__", "scene_name", "window_id", F.substring("asset.asset_id", 1, 12),
                F.concat(frame_name(frame), F.lit("_c"), "camera_id"),
            ).alias("sample_id"),
            *CELL,
            "obj_id",
            F.array("obj_id").alias("selected_obj_ids"),
            F.array("asset").alias("assets"),
            "review_images",
        )
        .withColumn("job_sha256", job_sha())
    )


def window_binding_conflicts(jobs: DataFrame) -> DataFrame:
    """Objects whose binding changes within a window."""
    return (
        jobs.select(*WINDOW, "obj_id", canonical_json(F.col("assets")).alias("binding"))
        .distinct()
        .groupBy(*WINDOW, "obj_id")
        .agg(F.count(F.lit(1)).alias("binding_count"))
        .filter("binding_count > 1")
    )


def variants(members: DataFrame) -> DataFrame:
    """Objects of each instance in a window, sorted."""
    return (
        members.select(*WINDOW, "instance_token", "obj_id")
        .distinct()
        .groupBy(*WINDOW, "instance_token")
        .agg(F.sort_array(F.collect_list("obj_id")).alias("objects"))
    )


def enumerate_combinations(instance_variants: DataFrame, max_enumeration: int | None = None) -> DataFrame:
    """All selections of a window: none or one variant per instance, not all none.

    The selections of a window are numbered by mixed radix: the digit of an instance
    says which of its variants is taken, zero that none is. Ranges of at most 4096
    numbers are dealt to the tasks and each number is decoded where it lands, so no
    row holds more than one selection and a large window keeps every task busy.
    Nothing is left out; a caller that wants a window of more than
    ``max_enumeration`` selections to fail by name can say so, and one whose numbers
    don't fit 62 bits always does.
    """
    places = "aggregate(choices, array(1L), (a, v) -> concat(a, array(element_at(a, -1) * (size(v) + 1))))"
    error = F.raise_error(F.concat(F.lit("too many combinations in "), F.concat_ws(":", *WINDOW))).cast("array<bigint>")
    most = math.log2(max_enumeration) if max_enumeration is not None else 62
    windows = (
        instance_variants.groupBy(*WINDOW)
        .agg(
            F.sort_array(F.collect_list(F.struct("instance_token", "objects"))).alias("v"),
            F.sum(F.size("objects")).alias("member_count"),
            F.sum(F.log2(F.size("objects") + 1)).alias("bits"),
        )
        .select(*WINDOW, "member_count", "bits", F.transform("v", lambda v: v["objects"]).alias("choices"))
        .withColumn("places", F.when(F.col("bits") <= min(most, 62) + 1e-9, F.expr(places)).otherwise(error))
    )
    # Wide ranges first, as one window may have more ranges than an array should hold.
    wide = windows.withColumn("first", F.explode(F.expr(f"sequence(0L, element_at(places, -1) - 1, {_FOLD * _FOLD}L)")))
    end = f"least(first + {_FOLD * _FOLD}L, element_at(places, -1)) - 1"
    ranges = wide.withColumn("first", F.explode(F.expr(f"sequence(first, {end}, {_FOLD}L)")))
    # A stated number, as adaptive execution would coalesce rows that are few until unfolded.
    parts = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(parts, *WINDOW, "first")
    numbered = dealt.withColumn("number", F.explode(F.expr(f"sequence(first, least(first + {_FOLD}L, element_at(places, -1)) - 1)")))
    taken = "transform(choices, (v, i) -> get(v, cast((number div places[i]) % (size(v) + 1) as int) - 1))"
    selected = F.sort_array(F.filter(F.expr(taken), lambda o: o.isNotNull()))
    return numbered.filter("number > 0").select(*WINDOW, selected.alias("selected"), "member_count")


def selection_rank_key(seed: int) -> Column:
    """Seeded hash that orders the selections of a window."""
    return canonical_sha(
        F.struct(
            F.lit(seed).alias("seed"),
            F.col("selected").alias("selected_obj_ids"),
            F.concat_ws(":", *WINDOW).alias("window"),
        )
    )


def cap_combinations(combinations: DataFrame, cap: int, seed: int) -> DataFrame:
    """Keep, per window, the combinations of least seeded hash that fit beside its singles.

    The constant bound lets Spark cut each window to ``cap`` rows before the
    shuffle; the exact bound follows.
    """
    if cap < 0:
        raise ValueError("the cap must not be negative")
    if not cap:
        return combinations
    ranked = combinations.withColumn("_key", selection_rank_key(seed)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*WINDOW).orderBy("_key"))
    )
    return ranked.filter((F.col("_rank") <= cap) & (F.col("_rank") <= cap - F.col("member_count"))).drop("_key", "_rank")


def window_selections(instance_variants: DataFrame, cap: int, seed: int, max_enumeration: int | None = None) -> DataFrame:
    """Singles, always kept, and the capped combinations of two or more."""
    singles = instance_variants.select(*WINDOW, F.explode("objects").alias("o")).select(*WINDOW, F.array("o").alias("selected"))
    combos = enumerate_combinations(instance_variants, max_enumeration).filter(F.size("selected") > 1)
    return singles.unionByName(cap_combinations(combos, cap, seed).drop("member_count"))


def ordered_selections(selections: DataFrame) -> DataFrame:
    return selections.orderBy(*WINDOW, F.size("selected"), "selected")


def object_mask(objects: Column, wanted: Column) -> Column:
    """Which of ``objects`` are ``wanted``, as bits of as many longs as are needed."""
    word = lambda w: F.aggregate(
        F.transform(
            F.slice(objects, w * _WORD + 1, F.lit(_WORD)),
            lambda o, i: F.when(F.array_contains(wanted, o), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")),
        ),
        F.lit(0).cast("long"),
        lambda a, b: a.bitwiseOR(b),
    )
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(objects) - 1) / _WORD).cast("int")), word)


def project_combinations(combinations: DataFrame, jobs: DataFrame) -> DataFrame:
    """Combinations of a window on each (frame, camera) that shows all their objects.

    The objects of a window are numbered in order; a cell and a selection are bit masks
    over them, and a selection is shown where its mask lies in the cell's. The join
    goes through the first object of a selection, so a cell meets only selections that
    start with an object it shows; it carries masks and numbers. ``members``, with the
    assets and images of the selected objects, is attached to what is left. A window's
    objects are bounded by the enumeration.
    """
    objects = jobs.groupBy(*WINDOW).agg(F.sort_array(F.collect_set("obj_id")).alias("objects"))
    first = F.array_position("objects", F.get("selected", F.lit(0)))
    wanted = (
        combinations.join(objects, WINDOW)
        .filter(F.size(F.array_except("selected", "objects")) == 0)
        .select(*WINDOW, first.alias("anchor"), "selected", object_mask(F.col("objects"), F.col("selected")).alias("asked"))
    )
    cells = (
        jobs.groupBy(*CELL)
        .agg(F.collect_set("obj_id").alias("ids"))
        .join(objects, WINDOW)
        .withColumn("shown", object_mask(F.col("objects"), F.col("ids")))
        .withColumn("anchors", F.transform("ids", lambda o: F.array_position("objects", o)))
        .select(*CELL, "shown", F.explode("anchors").alias("anchor"))
    )
    inside = F.expr("forall(zip_with(asked, shown, (a, s) -> a & ~s), x -> x = 0)")
    hits = cells.join(wanted, [*WINDOW, "anchor"]).filter(inside).select(*CELL, "selected")
    member = F.struct("obj_id", F.get("assets", F.lit(0)).alias("asset"), "review_images")
    bound = jobs.groupBy(*CELL).agg(F.collect_list(member).alias("all_members"))
    chosen = F.filter("all_members", lambda m: F.array_contains("selected", m["obj_id"]))
    return hits.join(bound, CELL).select(*CELL, "selected", chosen.alias("members"))


def combination_jobs(projected: DataFrame) -> DataFrame:
    """Jobs for projected combinations, shaped like single-asset ones."""
    chosen = F.expr("transform(selected, o -> get(filter(members, m -> m.obj_id = o), 0))")
    images = F.expr(
        """map_from_entries(flatten(transform(picked, (m, i) -> transform(map_entries(m.review_images),
             e -> struct(concat('asset_', i, '_', e.key) as key, e.value as value)))))"""
    )
    part = F.substring(canonical_sha(F.transform("assets", lambda a: a["asset_id"])), 1, 12)
    return (
        projected.withColumn("picked", chosen)
        .withColumn("assets", F.transform("picked", lambda m: m["asset"]))
        .select(
            F.concat_ws(
                "__", "scene_name", "window_id", F.concat(F.lit("cmb-"), part),
                F.concat(frame_name(F.col("frame_index")), F.lit("_c"), "camera_id"),
            ).alias("sample_id"),
            *CELL,
            F.lit(None).cast("string").alias("obj_id"),
            F.col("selected").alias("selected_obj_ids"),
            "assets",
            images.alias("review_images"),
        )
        .withColumn("job_sha256", job_sha())
    )


def build_plan(
    observations: DataFrame,
    assets: DataFrame,
    identity: DataFrame | None = None,
    min_area: int = 30,
    min_visibility: int = 2,
    cap: int = 256,
    seed: int = 20260818,
    strict: bool = True,
    max_enumeration: int | None = None,
) -> DataFrame:
    """All jobs of a plan: single-asset ones and combinations.

    The single-asset jobs, and in strict mode the assets and bound observations, are read
    by several steps and therefore written once.
    Strict mode checks the plan and raises on the first kind of violation found:
    an asset or identity row repeated for one object would multiply observations,
    and every job needs an id of its own.
    """
    if strict:
        assets = staged(assets, "assets")
        require_empty(key_violations(assets, ["obj_id"]), "an object has no id or several assets")
        if identity is not None:
            require_empty(key_violations(identity, ["obj_id"]), "an object has no id or several identity rows")
        # Tokens are checked on all observations, so they are bound once, before the eligible are chosen.
        every = staged(bind_assets(observations, assets), "bound")
        require_empty(every.filter("token_differs").select("obj_id"), "instance token differs")
        bound = eligible_observations(every, min_area, min_visibility)
    else:
        bound = bind_assets(eligible_observations(observations, min_area, min_visibility), assets)
    if identity is not None:
        bound = bind_identity(bound, identity)
        if strict:
            require_empty(bound.filter(F.col("identity_code").isNotNull()).select("obj_id", "identity_code"), "identity evidence")
    singles = staged(to_jobs(review_evidence(bound)), "jobs")
    if strict:
        require_empty(singles.filter(camera_violations(F.array("camera_id"))).select("sample_id"), "unknown camera")
        incomplete = blank(F.col("scene_name")) | (value_or(F.col("frame_index"), -1) < 0)
        require_empty(singles.filter(incomplete).select("sample_id"), "no scene or frame")
        require_empty(duplicate_observations(singles), "duplicate observation")
        require_empty(window_binding_conflicts(singles), "binding changes within a window")
    members = singles.select(*WINDOW, F.get("assets", F.lit(0))["instance_token"].alias("instance_token"), "obj_id")
    picked = window_selections(variants(members), cap, seed, max_enumeration).filter(F.size("selected") > 1)
    combined = combination_jobs(project_combinations(picked, singles))
    if not strict:
        return singles.unionByName(combined)
    jobs = singles.unionByName(staged(combined, "combinations"))
    require_empty(key_violations(jobs, ["sample_id"]), "a job has no id or one that another has")
    return jobs


def ordered_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy("sample_id")


def plan_summary(jobs: DataFrame) -> DataFrame:
    """One row of counts; distinct values are reduced before they are counted."""
    assets = jobs.select(F.explode("assets").alias("a")).select("a.asset_id").distinct().agg(F.count(F.lit(1)))
    scenes = jobs.select("scene_name").distinct().agg(F.count(F.lit(1)))
    return jobs.agg(
        F.count(F.lit(1)).alias("job_count"),
        F.count_if(F.size("assets") > 1).alias("combination_job_count"),
        *[F.count_if(F.col("camera_id") == c).alias(f"camera_{c}") for c in CAMERAS],
    ).select(
        "job_count",
        assets.scalar().alias("asset_count"),
        "combination_job_count",
        scenes.scalar().alias("scene_count"),
        F.map_filter(
            F.create_map(*[x for c in CAMERAS for x in (F.lit(c), F.col(f"camera_{c}"))]), lambda k, v: v > 0
        ).alias("camera_counts"),
    )
