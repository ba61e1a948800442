"""Six-camera rings: which asset sets of a frame form a complete group.

The record table is reduced early: aliases are resolved once per distinct asset
list, backgrounds once per distinct content, and visibility is kept as one
camera bit mask per (scene, frame, asset). No step collects a group whose size
grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairgrid.functions.hashing import canonical_sha
from pairgrid.functions.semantics import (
    CAMERAS,
    RING,
    ROLES,
    blank,
    camera_bit,
    cameras_in,
    first_text,
    frame_name,
    is_true,
    nonempty_sorted_set,
    role_file,
    split_view_key,
)
from pairgrid.session import keep_dealt

ALL_CAMERAS = (1 << len(CAMERAS)) - 1
IMAGES_PER_RING = len(RING) * len(ROLES)

NO_EVIDENCE = "selected asset has no explicit visibility evidence"
NO_PAIR = "has no matching audited pair"
CONFLICT = "has conflicting audited inputs"


# --- visibility manifest -------------------------------------------------


def canonical_id() -> Column:
    """Canonical asset id of a visibility job."""
    return first_text(
        F.col("exact_asset_binding.global_uid"),
        F.col("global_uid"),
        F.col("exact_asset_binding.obj_id"),
        F.col("obj_id"),
    )


def visibility_violations(jobs: DataFrame) -> DataFrame:
    """Jobs lacking an identity or category, and keys naming an unknown camera."""
    named = jobs.select(
        "scene_name",
        canonical_id().alias("asset_id"),
        first_text(F.col("exact_asset_binding.category"), F.col("category")).alias("category"),
        "target_usable_by_frame_camera",
    )
    identity = named.select(
        "scene_name",
        "asset_id",
        F.when(blank(F.col("scene_name")) | blank(F.col("asset_id")), "incomplete_identity")
        .when(blank(F.col("category")), "no_category")
        .alias("code"),
    )
    keys = named.select("scene_name", "asset_id", F.explode("target_usable_by_frame_camera").alias("k", "v"))
    frame, camera = split_view_key(F.col("k"))
    unknown = keys.filter(is_true(F.col("v")) & (frame.isNull() | ~F.coalesce(camera, F.lit("")).isin(*CAMERAS))).select(
        "scene_name", "asset_id", F.lit("unknown_camera").alias("code")
    )
    return identity.filter(F.col("code").isNotNull()).unionByName(unknown).distinct()


def alias_table(jobs: DataFrame) -> DataFrame:
    """Every identifier of an asset and its canonical id, one row per pair."""
    canonical = canonical_id()
    return (
        jobs.select(
            F.explode(
                F.array(
                    canonical,
                    "exact_asset_binding.global_uid",
                    "global_uid",
                    "exact_asset_binding.obj_id",
                    "obj_id",
                    "exact_asset_binding.instance_token",
                    "instance_token",
                )
            ).alias("alias"),
            canonical.alias("asset_id"),
        )
        .filter(~blank(F.col("alias")))
        .distinct()
    )


def alias_conflicts(jobs: DataFrame) -> DataFrame:
    """Identifiers claimed by more than one asset."""
    return alias_table(jobs).groupBy("alias").agg(F.count(F.lit(1)).alias("asset_count")).filter("asset_count > 1")


def category_conflicts(jobs: DataFrame) -> DataFrame:
    """Assets whose category differs between jobs."""
    return (
        jobs.select(
            canonical_id().alias("asset_id"),
            first_text(F.col("exact_asset_binding.category"), F.col("category")).alias("category"),
        )
        .distinct()
        .groupBy("asset_id")
        .agg(F.count(F.lit(1)).alias("category_count"))
        .filter("category_count > 1")
    )


def asset_categories(jobs: DataFrame) -> DataFrame:
    return jobs.select(
        canonical_id().alias("asset_id"),
        first_text(F.col("exact_asset_binding.category"), F.col("category")).alias("category"),
    ).distinct()


def visibility(jobs: DataFrame) -> DataFrame:
    """(scene, frame, asset) with the cameras in which it is usable, as a bit mask.

    Only the boolean true counts as usable.
    """
    frame, camera = split_view_key(F.col("k"))
    return (
        jobs.select("scene_name", canonical_id().alias("asset_id"), F.explode("target_usable_by_frame_camera").alias("k", "v"))
        .filter(is_true(F.col("v")))
        .select("scene_name", frame.alias("frame_index"), "asset_id", camera_bit(camera).alias("bit"))
        .groupBy("scene_name", "frame_index", "asset_id")
        .agg(F.bit_or("bit").alias("camera_mask"))
    )


# --- records -------------------------------------------------------------


def record_assets(layers: Column | None, assets: Column | None) -> Column:
    """Asset list of a record: layer ids when a layer list is present, else asset ids.

    One empty id empties the list. ``layers`` is an array of structs holding
    ``obj_id``; ``assets`` an array of structs holding any of the four ids.
    """
    found = F.lit(None).cast("array<string>")
    if assets is not None:
        found = F.transform(
            F.coalesce(assets, F.array()),
            lambda a: first_text(a["global_uid"], a["obj_id"], a["asset_id"], a["instance_token"]),
        )
    if layers is not None:
        of_layers = F.transform(layers, lambda a: first_text(a["obj_id"]))
        found = F.when(layers.isNotNull(), of_layers).otherwise(found)
    return nonempty_sorted_set(found)


def asset_signature(records: DataFrame, aliases: DataFrame, assets: str = "assets", within: Sequence[str] = ()) -> DataFrame:
    """Add ``signature``: the sorted canonical ids of ``assets``.

    One id without a canonical empties the whole signature. Two aliases of one
    asset both count. An alias that several assets claim stops the job by name;
    :func:`alias_conflicts` lists them all. Aliases are looked up once per distinct asset list, so a
    list shared by many records is resolved once; the join back carries one row
    per list, which adaptive execution can split or broadcast by its size.

    ``within`` names a column without nulls by which the records are dealt already. Lists
    are then looked up once for each of its values, and the records stay where they are and
    unsorted: a task holds the lists of its part, each once, in a hash table.
    """
    if within:
        keep_dealt(records.sparkSession)
    key = [*within, "_list"]
    lists = records.select(*within, nonempty_sorted_set(F.col(assets)).alias("_list")).distinct()
    unclear = F.raise_error(F.concat(F.lit("alias of several assets: "), F.col("alias")))
    known = (
        aliases.groupBy("alias")
        .agg(F.min("asset_id").alias("asset_id"), F.max("asset_id").alias("_other"))
        .select("alias", F.when(F.col("asset_id") == F.col("_other"), F.col("asset_id")).otherwise(unclear).alias("asset_id"))
    )
    found = lists.select(*key, F.explode("_list").alias("alias")).join(known, "alias", "left").drop("alias")
    resolved = (
        (found.repartition(*within) if within else found)
        .groupBy(*key)
        .agg(
            F.sort_array(F.collect_list("asset_id")).alias("signature"),
            F.count(F.lit(1)).alias("_ids"),
        )
        .select(
            *key,
            F.when(F.size("signature") == F.col("_ids"), F.col("signature"))
            .otherwise(F.array().cast("array<string>"))
            .alias("signature"),
        )
    )
    return (
        records.withColumn("_list", nonempty_sorted_set(F.col(assets)))
        .join(resolved.hint("shuffle_hash") if within else resolved, key, "left")
        .withColumn("signature", F.coalesce("signature", F.array().cast("array<string>")))
        .drop("_list")
    )


def record_violations(records: DataFrame) -> DataFrame:
    """Records without scene, frame or a known camera."""
    return records.filter(
        blank(F.col("scene_name"))
        | (F.coalesce("frame_index", F.lit(-1)) < 0)
        | ~F.coalesce("camera_id", F.lit("")).isin(*CAMERAS)
    ).select("sample_id")


def ring_refusals(records: DataFrame, jobs: DataFrame) -> DataFrame:
    """What a strict ring build refuses: a code and the asset, alias or record it is about.

    A manifest without a single usable camera, and a table without records, give a row
    of their own with no subject.
    """
    used = F.exists(F.map_values("target_usable_by_frame_camera"), lambda v: is_true(v))
    seen = jobs.agg(F.count_if(F.coalesce(used, F.lit(False))).alias("n"))
    return (
        visibility_violations(jobs).select("code", F.col("asset_id").alias("subject"))
        .unionByName(category_conflicts(jobs).select(F.lit("changed_category").alias("code"), F.col("asset_id").alias("subject")))
        .unionByName(alias_conflicts(jobs).select(F.lit("ambiguous_alias").alias("code"), F.col("alias").alias("subject")))
        .unionByName(record_violations(records).select(F.lit("invalid_record").alias("code"), F.col("sample_id").alias("subject")))
        .distinct()
        .unionByName(seen.filter("n = 0").select(F.lit("no_evidence").alias("code"), F.lit(None).cast("string").alias("subject")))
        .unionByName(
            records.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
            .select(F.lit("no_records").alias("code"), F.lit(None).cast("string").alias("subject"))
        )
    )


def select_scenes(records: DataFrame, scenes: Sequence[str]) -> DataFrame:
    return records.filter(F.col("scene_name").isin(*scenes)) if scenes else records


def complete_frames(records: DataFrame) -> DataFrame:
    """Frames with all six cameras, each showing exactly one background.

    Distinct backgrounds come first (hash aggregation with map-side combine);
    six of them over six cameras is then the whole test.
    """
    return (
        records.select("scene_name", "frame_index", "camera_id", "content_sha256.gt", "content_sha256.target")
        .distinct()
        .groupBy("scene_name", "frame_index")
        .agg(F.count(F.lit(1)).alias("backgrounds"), F.bit_or(camera_bit(F.col("camera_id"))).alias("cameras"))
        .filter((F.col("backgrounds") == len(CAMERAS)) & (F.col("cameras") == ALL_CAMERAS))
        .select("scene_name", "frame_index")
    )


def frame_baselines(records: DataFrame) -> DataFrame:
    """Complete frames with, per camera, the donor of least ``sample_id``.

    ``baselines`` has six entries in ring order. The per-camera minimum is taken
    before the frames are formed, so no group is collected.
    """
    per_background = records.groupBy(
        "scene_name", "frame_index", "camera_id", F.col("content_sha256.gt").alias("gt"),
        F.col("content_sha256.target").alias("target"),
    ).agg(F.min("sample_id").alias("sample_id"))
    least = [
        F.min(F.when(F.col("camera_id") == camera, F.struct("sample_id", "gt", "target"))).alias(f"b{camera}")
        for camera, _ in RING
    ]
    return (
        per_background.groupBy("scene_name", "frame_index")
        .agg(F.count(F.lit(1)).alias("_n"), F.bit_or(camera_bit(F.col("camera_id"))).alias("_cameras"), *least)
        .filter((F.col("_n") == len(CAMERAS)) & (F.col("_cameras") == ALL_CAMERAS))
        .select("scene_name", "frame_index", F.array(*[F.col(f"b{camera}") for camera, _ in RING]).alias("baselines"))
    )


def exact_pairs(signed: DataFrame) -> DataFrame:
    """One row per exact (scene, frame, camera, signature): least source and input agreement."""
    return (
        signed.filter(F.size("signature") > 0)
        .groupBy("scene_name", "frame_index", "camera_id", "signature")
        .agg(
            F.min(F.struct("sample_id", F.col("content_sha256.input").alias("input"))).alias("pair"),
            F.min("content_sha256.input").alias("_low"),
            F.max("content_sha256.input").alias("_high"),
        )
        .withColumn("conflicting", F.col("_low") != F.col("_high"))
        .drop("_low", "_high")
    )


def pair_conflicts(signed: DataFrame) -> DataFrame:
    """Exact pair keys whose records disagree on the input image."""
    return exact_pairs(signed).filter("conflicting").select("scene_name", "frame_index", "camera_id", "signature")


def candidate_sets(signed: DataFrame) -> DataFrame:
    """Distinct (scene, frame, asset set)."""
    return (
        signed.filter(F.size("signature") > 0)
        .select("scene_name", "frame_index", F.col("signature").alias("selected"))
        .distinct()
    )


def select_categories(candidates: DataFrame, categories: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep sets whose every asset is in a wanted category."""
    if not wanted:
        return candidates
    allowed = categories.filter(F.col("category").isin(*wanted)).select("asset_id").distinct()
    lists = candidates.select("scene_name", "selected").distinct()
    refused = (
        lists.select("scene_name", "selected", F.explode("selected").alias("asset_id"))
        .join(allowed, "asset_id", "left_anti")
        .select("scene_name", "selected")
        .repartition("scene_name")
        .distinct()
    )
    return candidates.join(refused, ["scene_name", "selected"], "left_anti")


def visible_by_camera(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Add ``visible``: per ring position the selected assets seen there, in set order.

    Also ``unseen``: some selected asset has no camera at all in the frame. The objects of
    a frame, which the data model bounds, meet its candidates as one map of masks, so that no
    candidate is opened and put together again.
    """
    keep_dealt(candidates.sparkSession)
    frame = ["scene_name", "frame_index"]
    key = [*frame, "selected"]
    others = [c for c in candidates.columns if c not in key]
    entries = F.collect_list(F.struct("asset_id", "camera_mask"))
    masks = seen.filter("asset_id is not null").groupBy(*frame).agg(F.map_from_entries(entries).alias("_masks"))
    mask = lambda a: F.coalesce(F.try_element_at(F.col("_masks"), a), F.lit(0))
    masked = candidates.filter(F.size("selected") > 0).join(masks, frame, "left").select(
        *key, *others, F.transform("selected", lambda a: F.struct(a.alias("asset_id"), mask(a).alias("mask"))).alias("m")
    )

    def seen_by(camera: str) -> Column:
        bit = 1 << int(camera)
        return F.transform(F.filter("m", lambda a: a["mask"].bitwiseAND(F.lit(bit)) != 0), lambda a: a["asset_id"])

    return masked.select(
        *key,
        *others,
        F.array(*[seen_by(camera) for camera, _ in RING]).alias("visible"),
        F.exists("m", lambda a: a["mask"] == 0).alias("unseen"),
    )


def complete_sets(signed: DataFrame) -> DataFrame:
    """Distinct (scene, frame, asset set) of complete frames, with ``pairs`` and ``baselines``.

    ``pairs`` holds per ring position the exact pair and whether its inputs differ;
    ``baselines`` what :func:`frame_baselines` gives. Records are sorted once, by scene, frame
    and set: the frame's donors are minima over its sets, which lie beside each other then.
    """
    image, background = F.col("content_sha256.input"), F.struct("content_sha256.gt", "content_sha256.target")
    # The least record gives the pair and the donor: where its id is met twice, a complete frame has one background for both.
    record = F.struct("sample_id", image.alias("input"), "content_sha256.gt", "content_sha256.target")

    def of(camera: str, value: Column) -> Column:
        return F.when(F.col("camera_id") == camera, value)

    def least_of(c: str) -> list[Column]:
        return [
            F.min(of(c, record)).alias(f"r{c}"), F.min(of(c, image)).alias(f"l{c}"), F.max(of(c, image)).alias(f"h{c}"),
            F.min(of(c, background)).alias(f"g{c}"), F.max(of(c, background)).alias(f"k{c}"),
        ]

    frame = ["scene_name", "frame_index"]
    strange = ~F.coalesce(F.col("camera_id").isin(*CAMERAS), F.lit(False))
    sets = signed.filter("frame_index is not null").groupBy(*frame, F.col("signature").alias("selected")).agg(
        *[v for c, _ in RING for v in least_of(c)], F.bool_or(strange).alias("_strange")
    )
    over = Window.partitionBy(*frame)
    least, most = {c: F.min(f"g{c}").over(over) for c, _ in RING}, {c: F.max(f"k{c}").over(over) for c, _ in RING}
    whole = ~F.bool_or("_strange").over(over)
    for c, _ in RING:
        whole = whole & least[c].isNotNull() & least[c].eqNullSafe(most[c])
    def without(r: Column, *fields: str) -> Column:
        return F.when(r.isNotNull(), F.struct(*[r[f].alias(f) for f in ("sample_id", "input", "gt", "target") if f not in fields]))

    pairs = [F.struct(without(F.col(f"r{c}"), "gt", "target").alias("pair"), (F.col(f"l{c}") != F.col(f"h{c}")).alias("conflicting")) for c, _ in RING]
    framed = sets.select(*frame, "selected", F.array(*pairs).alias("pairs"), *[F.min(f"r{c}").over(over).alias(f"r{c}") for c, _ in RING], whole.alias("_whole"))
    return framed.filter(F.col("_whole") & (F.size("selected") > 0)).select(
        *frame, "selected", "pairs", F.array(*[without(F.col(f"r{c}"), "input") for c, _ in RING]).alias("baselines")
    )


def match_pairs(shown: DataFrame) -> DataFrame:
    """Add ``matched``: per ring position the exact pair of the assets seen there, if any.

    ``shown`` are all candidates of their frames with ``pairs`` and ``visible``. A view that
    shows a whole set finds the pair in its own row; one that shows a part of it asks the
    row of that set. Askers and asked meet in a window over (scene, frame, set); each asker
    knows the positions it asks for.
    """
    key = ["scene_name", "frame_index", "selected"]
    parts = F.array_distinct(F.filter("visible", lambda a: (F.size(a) > 0) & (a != F.col("selected"))))
    own = F.col("wanted") == F.col("selected")
    rest = [c for c in shown.columns if c not in key]
    asks = [F.get("visible", F.lit(i)) == F.col("wanted") for i in range(len(RING))]
    # The wanted sets are never none, so an outer explode gives the same rows; the plain one computes them twice.
    asked = (
        shown.select("*", F.explode_outer(F.concat(F.array("selected"), parts)).alias("wanted"))
        .withColumns({f"_a{i}": a for i, a in enumerate(asks)})
        .withColumns({c: F.when(own, F.col(c)) for c in rest})
    )
    same_set = Window.partitionBy("scene_name", "frame_index", "wanted")
    answered = asked.withColumn("_answer", F.first("pairs", ignorenulls=True).over(same_set))
    at = [F.first(F.when(F.col(f"_a{i}"), F.get("_answer", F.lit(i))), ignorenulls=True).alias(f"_m{i}") for i in range(len(RING))]
    whole = answered.groupBy(*key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest], *at)
    return whole.select(*key, *rest, F.array(*[F.col(f"_m{i}") for i in range(len(RING))]).alias("matched"))


def ring_candidates(
    records: DataFrame,
    jobs: DataFrame,
    scenes: Sequence[str] = (),
    categories: Sequence[str] = (),
    assets: str = "assets",
) -> DataFrame:
    """Every candidate group with its six views and, if it fails, the reason.

    The first failing camera in ring order decides the reason, missing before
    conflicting; it takes precedence over missing evidence. Every step groups or joins
    by the scene and more, so records and jobs that come dealt by scene are not dealt again.
    """
    key = ["scene_name", "frame_index", "selected"]
    used = select_scenes(records, scenes).filter(F.col("scene_name").isNotNull())
    signed = asset_signature(used, alias_table(jobs), assets, ["scene_name"])
    sets = select_categories(complete_sets(signed), asset_categories(jobs), categories)
    matched = match_pairs(visible_by_camera(sets, visibility(jobs)))

    def view(pos: int) -> Column:
        camera, name = RING[pos]
        return F.struct(
            F.lit(camera).alias("camera_id"),
            F.lit(name).alias("camera_name"),
            F.get("visible", F.lit(pos)).alias("applied"),
            F.get("matched", F.lit(pos))["pair"].alias("pair"),
            F.get("baselines", F.lit(pos)).alias("baseline"),
        )

    def failure(pos: int) -> Column:
        found, text = F.get("matched", F.lit(pos)), f"visible camera {RING[pos][0]} "
        return F.when((F.size(F.get("visible", F.lit(pos))) > 0) & found["pair"].isNull(), F.lit(text + NO_PAIR)).when(
            found["conflicting"], F.lit(text + CONFLICT)
        )

    return matched.select(
        *key,
        F.coalesce(*[failure(i) for i in range(len(RING))], F.when(F.col("unseen"), NO_EVIDENCE)).alias("reason"),
        F.array(*[view(i) for i in range(len(RING))]).alias("views"),
    )


def group_id(scene: Column, frame: Column, selected: Column) -> Column:
    return F.concat_ws(
        "__", scene, frame_name(frame), F.concat(F.lit("g-"), F.substring(canonical_sha(selected), 1, 12))
    )


def accepted_groups(candidates: DataFrame) -> DataFrame:
    return (
        candidates.filter(F.col("reason").isNull())
        .withColumn("group_id", group_id(F.col("scene_name"), F.col("frame_index"), F.col("selected")))
        .withColumn(
            "visible_cameras", F.aggregate("views", F.lit(0), lambda n, v: n + (F.size(v["applied"]) > 0).cast("int"))
        )
        .drop("reason")
    )


def excluded_groups(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("reason").isNotNull()).select("scene_name", "frame_index", "selected", "reason")


def candidate_groups(
    records: DataFrame,
    jobs: DataFrame,
    scenes: Sequence[str] = (),
    categories: Sequence[str] = (),
    assets: str = "assets",
) -> tuple[DataFrame, DataFrame]:
    """Accepted groups and excluded sets with a reason."""
    candidates = ring_candidates(records, jobs, scenes, categories, assets)
    return accepted_groups(candidates), excluded_groups(candidates)


def top_groups(groups: DataFrame, limit: int = 0) -> DataFrame:
    """Most visible cameras first, then group id; 0 keeps all."""
    ordered = groups.orderBy(F.desc("visible_cameras"), "group_id")
    return ordered.limit(limit) if limit else ordered


def ring_records(groups: DataFrame) -> DataFrame:
    """Published group rows: six ordered views with files, hashes and sources.

    A view that shows no selected asset takes the target image as its input.
    """

    def view(v: Column) -> Column:
        edited = v["pair"].isNotNull()
        name = v["camera_name"]
        return F.struct(
            v["camera_id"].alias("camera_id"),
            name.alias("camera_name"),
            edited.alias("asset_visible"),
            v["applied"].alias("applied_asset_ids"),
            v["pair"]["sample_id"].alias("source_pair_sample_id"),
            v["baseline"]["sample_id"].alias("baseline_sample_id"),
            F.struct(*[role_file(F.col("group_id"), name, F.lit(r)).alias(r) for r in ROLES]).alias("files"),
            F.struct(
                v["baseline"]["gt"].alias("gt"),
                F.when(edited, v["pair"]["input"]).otherwise(v["baseline"]["target"]).alias("input"),
                v["baseline"]["target"].alias("target"),
            ).alias("content_sha256"),
        )

    return groups.select(
        F.lit(1).alias("schema_version"),
        "group_id",
        "scene_name",
        "frame_index",
        F.col("selected").alias("selected_asset_ids"),
        F.transform("views", view).alias("views"),
    ).withColumn("record_sha256", ring_record_sha())


def ring_record_sha() -> Column:
    """Hash of a group row without its own hash; fields in name order."""

    def view(v: Column) -> Column:
        return F.struct(
            *[
                v[f].alias(f)
                for f in (
                    "applied_asset_ids", "asset_visible", "baseline_sample_id", "camera_id", "camera_name",
                    "content_sha256", "files", "source_pair_sample_id",
                )
            ]
        )

    return canonical_sha(
        F.struct(
            F.col("frame_index"),
            F.col("group_id"),
            F.col("scene_name"),
            F.col("schema_version"),
            F.col("selected_asset_ids"),
            F.transform("views", view).alias("views"),
        )
    )


def ring_sources(groups: DataFrame) -> DataFrame:
    """Flat copy list: (group, camera, role) with the source record, role and hash."""
    v = F.explode("views").alias("v")
    edited = F.col("v.pair").isNotNull()
    per_role = F.array(
        *[
            F.struct(
                F.lit(role).alias("role"),
                (F.when(edited, F.lit("input")).otherwise(F.lit("target")) if role == "input" else F.lit(role)).alias("source_role"),
                (F.coalesce("v.pair.sample_id", "v.baseline.sample_id") if role == "input" else F.col("v.baseline.sample_id")).alias(
                    "source_sample_id"
                ),
                (
                    F.when(edited, F.col("v.pair.input")).otherwise(F.col("v.baseline.target"))
                    if role == "input"
                    else F.col(f"v.baseline.{role}")
                ).alias("sha256"),
            )
            for role in ROLES
        ]
    )
    return (
        groups.select("group_id", v)
        .select("group_id", "v.camera_id", "v.camera_name", F.explode(per_role).alias("s"))
        .select(
            "group_id",
            "camera_id",
            "s.*",
            role_file(F.col("group_id"), F.col("camera_name"), F.col("s.role")).alias("file_name"),
        )
    )


def ring_summary(records: DataFrame, candidates: DataFrame, limit: int = 0) -> DataFrame:
    """One row of counts; the frame counts come from the records in use."""
    frames = records.select("scene_name", "frame_index").distinct().agg(F.count(F.lit(1)))
    full = complete_frames(records).agg(F.count(F.lit(1)))
    good = F.count_if(F.col("reason").isNull())
    published = F.least(good, F.lit(limit)) if limit else good
    return candidates.agg(
        F.count(F.lit(1)).alias("candidate_group_count"),
        good.alias("complete_group_count_before_limit"),
        F.count_if(F.col("reason").isNotNull()).alias("excluded_group_count"),
        published.alias("group_count"),
        (published * IMAGES_PER_RING).alias("image_count"),
    ).select(
        frames.scalar().alias("source_scene_frame_count"),
        full.scalar().alias("complete_unambiguous_ring_frame_count"),
        "*",
    )
