"""Independent checks of records, results, reviews, files and rings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain, groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairgrid.functions.gates import cleanup_receipt, dimensions_ok, geometry_pass
from pairgrid.functions.hashing import bound_to_itself, kind_of, signed
from pairgrid.functions.semantics import (
    CAMERAS,
    FORWARD_AXIS,
    RING,
    ROLES,
    blank,
    codes,
    is_hash,
    is_true,
    not_true,
    packed,
    require_empty,
    role_file,
    text,
    value_or,
)
from pairgrid.operators.review import hard_failure
from pairgrid.operators.rings import group_id, ring_record_sha, visible_by_camera
from pairgrid.session import staged


# --- table against table -------------------------------------------------


def reconcile(expected: DataFrame, observed: DataFrame, keys: list[str], few: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """Keys found on one side only, as ``missing`` or ``extra``.

    One aggregation over both sides: repeats combine before the shuffle, so a
    key that fills a large share of a side costs nothing extra. ``few`` names a text key
    and its usual values: these move as one row of the other keys, any other value as its own.
    """
    tagged = expected.select(*keys, F.lit(1).alias("_side")).unionByName(observed.select(*keys, F.lit(2).alias("_side")))
    name, usual = few or (None, ())
    known = F.coalesce(F.col(name).isin(*usual), F.lit(False)) if few else F.lit(False)
    place = [F.when(~known, F.col(k)).alias(k) if k == name else F.col(k) for k in keys]
    values = [F.col(name) == v for v in usual]
    sides = [F.bit_or(F.when(rule, F.col("_side"))).alias(f"_side{i}") for i, rule in enumerate([*values, ~known])]
    found = tagged.groupBy(*place).agg(*sides)
    rows = [(F.lit(v) if few else None, F.col(f"_side{i}")) for i, v in enumerate(usual)] + [(F.col(name) if few else None, F.col(f"_side{len(usual)}"))]
    each = F.array(*[F.struct(*([v.alias("value")] if few else []), side.alias("side")) for v, side in rows])
    single = found.select(*[k for k in keys if k != name], F.explode(F.filter(each, lambda x: x["side"] != 3)).alias("_s"))
    return single.select(
        *[F.col("_s.value").alias(k) if k == name else F.col(k) for k in keys], F.when(F.col("_s.side") == 1, "missing").otherwise("extra").alias("side")
    )


def reconcile_counts(differences: DataFrame) -> DataFrame:
    return differences.agg(
        F.count_if(F.col("side") == "missing").alias("missing_count"), F.count_if(F.col("side") == "extra").alias("extra_count")
    )


def content_rows(records: DataFrame) -> DataFrame:
    """Records opened into one row per role with the file name and declared hash."""
    return records.select(
        "sample_id",
        F.explode(
            F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"content_sha256.{r}").alias("expected")) for r in ROLES])
        ).alias("c"),
    ).select("sample_id", "c.role", F.concat("sample_id", F.lit(".png")).alias("name"), "c.expected")


def _told(role: Column, value: Column, owner: Column | None = None) -> Column:
    """A role and what tells its hash, as bytes: a mark, half of the SHA-256 of the hash's text, and what is unusual as JSON.

    The mark is the number of the role, 3 for any other, with 8 for a text and 4 more for one of a hash's length.
    """
    number = F.lit(len(ROLES))
    for i, r in enumerate(ROLES):
        number = F.when(role == r, F.lit(i)).otherwise(number)
    nothing = F.unhex(F.lit(""))
    mark = F.unhex(F.hex((number + F.when(value.isNull(), 0).when(is_hash(value), 12).otherwise(8)).cast("bigint")))
    half = F.when(value.isNull(), nothing).otherwise(F.substring(F.unhex(F.sha2(value.cast("binary"), 256)), 1, 16))
    usual = number < len(ROLES) if owner is None else (number < len(ROLES)) & owner.isNull()
    more = F.to_json(F.struct(role.alias("role"), *([owner.alias("owner")] if owner is not None else [])))
    return F.concat(mark, half, F.when(usual, nothing).otherwise(more.cast("binary")))


def _parts(c: Column) -> Column:
    """What :func:`_told` was given; of the hash, its half."""
    mark = F.conv(F.hex(F.substring(c, 1, 1)), 16, 10).cast("int")
    more = F.substring(c, F.when(mark >= 8, 18).otherwise(2), F.length(c)).cast("string")
    role = F.get(F.array(*[F.lit(r) for r in ROLES]), mark % 4)
    return F.struct(
        F.when(more == "", role).otherwise(F.get_json_object(more, "$.role")).alias("role"),
        (mark >= 12).alias("sound"),
        F.when(mark >= 8, F.substring(c, 2, 16)).alias("hash"),
        F.from_json(F.get_json_object(more, "$.owner"), "sample_id string").alias("owner"),
    )


def content_sets(records: DataFrame) -> DataFrame:
    """Records with their file's ``name`` and, in ``wanted``, what tells the hashes of all roles: :func:`content_rows` unopened."""
    each = [_told(F.lit(r), F.col(f"content_sha256.{r}")) for r in ROLES]
    return records.withColumns({"name": F.concat("sample_id", F.lit(".png")), "wanted": F.array(*each)})


def _met(rows: DataFrame, files: DataFrame, place: Sequence[str]) -> DataFrame:
    """``wanted`` and ``stored`` of each place; all roles of a side move as one row."""
    if "wanted" in rows.columns:
        wanted = rows.select(*place, "wanted")
    else:
        usual = F.concat("sample_id", F.lit(".png")).eqNullSafe(F.col("name"))
        own = _told(F.col("role"), F.col("expected"), F.when(~usual, F.struct("sample_id")))
        wanted = rows.groupBy(*place).agg(F.collect_list(own).alias("wanted"))
    stored = files.groupBy(*place).agg(F.collect_list(_told(F.col("role"), F.col("sha256"))).alias("stored"))
    return wanted.join(stored, list(place), "left")


def _opened(met: DataFrame) -> DataFrame:
    parts = met.select("name", F.transform("wanted", _parts).alias("wanted"), F.transform("stored", _parts).alias("stored"))
    given = F.when(F.col("w.owner").isNotNull(), F.col("w.owner.sample_id")).otherwise(F.expr("substring(name, 1, length(name) - 4)"))
    return (
        parts.select("name", "stored", F.explode_outer("wanted").alias("w"))
        .select("name", "w", F.explode_outer(F.filter("stored", lambda f: f["role"] == F.col("w.role"))).alias("s"))
        .select(
            given.alias("sample_id"), "w.role", "w.sound", F.col("s.hash").isNotNull().alias("found"), (F.col("w.hash") == F.col("s.hash")).alias("same")
        )
    )


def looked_up(rows: DataFrame, files: DataFrame, place: Sequence[str] = ("name",)) -> DataFrame:
    """Rows with ``sample_id``, ``role`` and ``expected`` beside the stored file of that role and ``place``.

    ``sound`` tells whether a hash was expected, ``found`` whether one is stored, ``same``
    whether it is that. The roles of a place combine before the shuffle and move as one row:
    of each hash 128 bits of its SHA-256, and an id only where the name doesn't give it.
    Rows may come combined, as :func:`content_sets` gives them. ``place`` holds ``name``.
    """
    return _opened(_met(rows, files, place))


def unlike(rows: DataFrame, files: DataFrame, place: Sequence[str] = ("name",)) -> DataFrame:
    """Rows of :func:`looked_up` that are unsound, not found or not the same. Places whose two sides are equal are not opened."""
    sound = F.forall("wanted", lambda w: (F.length(w) == 17) & (F.substring(w, 1, 1) >= F.unhex(F.lit("0C"))))
    alike = sound & F.coalesce(F.sort_array("wanted") == F.sort_array("stored"), F.lit(False))
    troubled = _opened(_met(rows, files, place).filter(~alike))
    return troubled.filter(~(F.col("sound") & F.col("found") & F.coalesce("same", F.lit(False))))


def content_errors(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Declared contents, opened or as :func:`content_sets`, against stored files on (role, name)."""
    return unlike(rows, files).select(
        "sample_id",
        "role",
        F.when(~F.col("sound"), "invalid_content_hash").when(~F.col("found"), "missing_file").otherwise("hash_mismatch").alias("code"),
    )


def bind_results(jobs: DataFrame, results: DataFrame, checkpoints: dict[str, str]) -> DataFrame:
    """Samples whose result is absent, unknown, repeated, incomplete or not bound to its job."""
    shared = ("job_sha256", "selected_obj_ids", "camera_id", "frame_index")
    wanted = F.sort_array(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in checkpoints.items()]))
    body = F.struct(*shared)
    left = jobs.select(
        "sample_id", F.lit(1).alias("job"), F.lit(0).alias("result"), body.alias("wanted"),
        F.lit(None).cast(jobs.select(body.alias("b")).schema["b"].dataType).alias("given"),
        F.lit(None).cast("boolean").alias("complete"), F.lit(None).cast("boolean").alias("same_checkpoints"),
    )
    right = results.select(
        "sample_id", F.lit(0).alias("job"), F.lit(1).alias("result"),
        F.lit(None).cast(jobs.select(body.alias("b")).schema["b"].dataType).alias("wanted"), body.alias("given"),
        (text(F.col("status")) == "complete").alias("complete"),
        F.coalesce(F.sort_array(F.map_entries("checkpoint_sha256")) == wanted, F.lit(False)).alias("same_checkpoints"),
    )
    both = left.unionByName(right).groupBy("sample_id").agg(
        F.sum("job").alias("jobs"),
        F.sum("result").alias("results"),
        F.max("wanted").alias("wanted"),
        F.max("given").alias("given"),
        F.bool_and("complete").alias("complete"),
        F.bool_and("same_checkpoints").alias("same_checkpoints"),
    )

    def differs(name: str) -> Column:
        return (F.col("jobs") > 0) & (F.col("results") > 0) & ~F.col(f"wanted.{name}").eqNullSafe(F.col(f"given.{name}"))

    return both.select(
        "sample_id",
        codes(
            {
                "missing_result": F.col("results") == 0,
                "unknown_result": F.col("jobs") == 0,
                "duplicate_result": F.col("results") > 1,
                "incomplete_result": F.col("complete").isNotNull() & ~F.col("complete"),
                "job_hash_differs": differs("job_sha256"),
                "objects_differ": differs("selected_obj_ids"),
                "camera_differs": differs("camera_id"),
                "frame_differs": differs("frame_index"),
                "checkpoints_differ": F.col("same_checkpoints").isNotNull() & ~F.col("same_checkpoints"),
            }
        ).alias("codes"),
    ).filter(F.size("codes") > 0)


def opportunity_index(jobs: DataFrame) -> DataFrame:
    """Frozen render opportunities on (scene, object, frame, camera); any true flag counts."""
    parts = F.split("k", ":c", 2)
    return jobs.select("*", F.explode("target_usable_by_frame_camera").alias("k", "v")).filter(is_true(F.col("v"))).select(
        "scene_name", "obj_id", parts[0].try_cast("int").alias("frame_index"), parts[1].alias("camera_id"),
        F.col("exact_asset_binding").alias("binding"), F.col("official_dimensions_m").alias("known_dimensions"),
    )


def close_to(a: Column, b: Column) -> Column:
    """Elementwise closeness with the usual absolute and relative tolerance."""
    same = F.forall(
        F.zip_with(a, b, lambda x, y: F.coalesce(F.abs(x - y) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(y), F.lit(False))), lambda v: v
    )
    return F.coalesce((F.size(a) == F.size(b)) & same, F.lit(False))


def bind_opportunities(jobs: DataFrame, index: DataFrame) -> DataFrame:
    """Job assets without a matching opportunity, or whose binding differs."""
    asset = F.col("asset")
    key = ["scene_name", "obj_id", "frame_index", "camera_id"]
    known = index.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.min("binding").alias("binding"), F.min("known_dimensions").alias("known_dimensions")
    )
    return (
        jobs.select("sample_id", "scene_name", "frame_index", "camera_id", F.explode("assets").alias("asset"))
        .withColumn("obj_id", asset["obj_id"])
        .join(known, key, "left")
        .select(
            "sample_id",
            "obj_id",
            F.when(F.col("_n").isNull(), F.array(F.lit("no_opportunity")))
            .otherwise(
                codes(
                    {
                        "ambiguous_opportunity": F.col("_n") > 1,
                        "token_differs": text(F.col("binding.instance_token")) != text(asset["instance_token"]),
                        "hash_differs": text(F.col("binding.asset_sha256")) != text(asset["asset_sha256"]),
                        "wrong_forward_axis": text(asset["forward_axis"]) != FORWARD_AXIS,
                        "dimensions_differ": ~close_to(F.col("known_dimensions"), asset["official_dimensions_m"]),
                    }
                )
            )
            .alias("codes"),
        )
        .filter(F.size("codes") > 0)
    )


def background_conflicts(layers: DataFrame) -> DataFrame:
    """Samples whose layers were rendered on different backgrounds."""
    return (
        layers.groupBy("sample_id")
        .agg(
            F.min("target_sha256").alias("t0"), F.max("target_sha256").alias("t1"),
            F.min("gt_sha256").alias("g0"), F.max("gt_sha256").alias("g1"),
        )
        .filter((F.col("t0") != F.col("t1")) | (F.col("g0") != F.col("g1")))
        .select("sample_id")
    )


def cleanup_rollup(layers: DataFrame) -> DataFrame:
    """One signed cleanup receipt per sample: usable and passed only if every layer's is.

    A sample has a handful of layers; their receipt hashes are kept in layer order.
    """
    sources = F.transform(F.sort_array(F.collect_list(F.struct("ord", "decision_sha256"))), lambda s: s["decision_sha256"])
    whole = layers.groupBy("sample_id").agg(
        cleanup_receipt(F.bool_and(is_true(F.col("usable"))), F.bool_and(is_true(F.col("passed"))), sources).alias("receipt")
    )
    return whole.select("sample_id", signed(whole, F.col("receipt")).alias("receipt")).select("sample_id", "receipt.*")


# --- record audit --------------------------------------------------------


def content_key(prefix: str = "") -> Column:
    """32-byte digest of the three role hashes: a short exact-content key."""
    return F.unhex(F.sha2(F.concat_ws("|", *[F.col(prefix + r) for r in ROLES]), 256))


def duplicate_triplets(records: DataFrame, order: str = "sample_id") -> DataFrame:
    """Records after the first, in ``order``, with the same three images.

    The first of each content comes from an aggregation that combines before the
    shuffle; the rest is an anti join on the unique order key. A content shared
    by a large part of the table therefore meets no single task.
    """
    flat = records.select(order, *[F.col(f"content_sha256.{r}").alias(r) for r in ROLES])
    firsts = flat.groupBy(content_key().alias("_content")).agg(F.min(order).alias(order))
    return records.join(firsts.select(order), order, "left_anti")


def _decision_of(review: Column, kind: T.StructType) -> Column:
    bound = bound_to_itself(review, kind) & (is_true(review["hard_failure"]) == hard_failure(review["decision"]))
    return F.when(~bound, F.lit("visual_review_binding_mismatch")).when(
        is_true(review["hard_failure"]), F.lit("visual_review_candidate")
    )


def record_errors(records: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Sorted distinct error codes of every record (empty when it is clean).

    A record may carry the hash of its other columns in ``record_sha256``, and a review
    must carry that of its own in ``decision_sha256``; both are computed anew from the
    rows. With a review table, a record that has no row there is not clean.
    """
    layers = F.coalesce("asset_layers", F.array())

    def any_layer(rule: Callable[[Column], Column]) -> Column:
        return F.exists(layers, rule)

    rules = {
        "invalid_identity_or_camera": blank(F.col("sample_id")) | ~F.coalesce("camera_id", F.lit("")).isin(*CAMERAS),
        "no_asset_layers": F.size(layers) == 0,
        "incomplete_asset_identity": any_layer(
            lambda x: blank(x["obj_id"]) | blank(x["instance_token"]) | blank(x["asset_sha256"])
        ),
        "invalid_dimensions_or_axis": any_layer(
            lambda x: ~dimensions_ok(x["official_dimensions_m"]) | (text(x["forward_axis"]) != FORWARD_AXIS)
        ),
        "geometry_candidate": any_layer(lambda x: ~geometry_pass(x["quality"])),
        "occlusion_regression_candidate": any_layer(lambda x: is_true(x["occlusion"]["renderer_occlusion_regression"])),
        "unverified_partial_occlusion": any_layer(
            lambda x: (value_or(x["occlusion"]["pixels"], 0) != 0) & not_true(x["occlusion"]["applied"])
        ),
    }
    if "record_sha256" in records.columns:
        own = F.struct(*records.columns)
        rules["record_binding_mismatch"] = (text(F.col("record_sha256")) != "") & ~bound_to_itself(own, kind_of(records, own), "record_sha256")
    own = records.select("sample_id", codes(rules).alias("_own"))
    if reviews is None:
        return own.select("sample_id", F.sort_array(F.array_distinct("_own")).alias("errors"))
    # Records and reviews are judged where they lie; only codes meet.
    told = reviews.select("sample_id", F.struct(*reviews.columns).alias("_review"))
    verdict = _decision_of(F.col("_review"), told.schema["_review"].dataType)
    judged = told.select("sample_id", F.lit(True).alias("_told"), verdict.alias("_verdict"))
    found = F.array_compact(F.array_append("_own", F.when(F.col("_told").isNull(), F.lit("visual_review_missing")).otherwise(F.col("_verdict"))))
    return own.join(judged, "sample_id", "left").select("sample_id", F.sort_array(F.array_distinct(found)).alias("errors"))


def review_membership(records: DataFrame, reviews: DataFrame) -> DataFrame:
    return reconcile(records, reviews, ["sample_id"])


def audit_release(
    records: DataFrame, files: DataFrame, reviews: DataFrame | None = None, order: str = "sample_id", strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Clean records, and the others with their reasons.

    A record without a review is one of the others; ``strict`` raises unless records
    and reviews have the same ids.

    Record rules, file checks and repeated content meet in one aggregation per
    record; only flagged rows enter it.
    """
    if strict and reviews is not None:
        require_empty(review_membership(records, reviews), "reviews do not match the records")
    own = record_errors(records, reviews).filter(F.size("errors") > 0).select("sample_id", F.explode("errors").alias("code"))
    stored = content_errors(content_sets(records), files).select("sample_id", "code")
    repeated = duplicate_triplets(records, order).select("sample_id", F.lit("duplicate_triplet_content").alias("code"))
    candidates = (
        own.unionByName(stored)
        .unionByName(repeated)
        .groupBy("sample_id")
        .agg(F.sort_array(F.collect_set("code")).alias("reasons"))
    )
    return records.join(candidates.select("sample_id"), "sample_id", "left_anti"), candidates


def audit_summary(records: DataFrame, candidates: DataFrame, checked: DataFrame) -> DataFrame:
    """One row: counts, whether every image was checked, and the status."""
    total = records.agg(F.count(F.lit(1)))
    images = checked.agg(F.count(F.lit(1)))
    return candidates.agg(
        F.count(F.lit(1)).alias("candidate_count"),
        F.count_if(F.array_contains("reasons", "duplicate_triplet_content")).alias("duplicate_triplet_count"),
    ).select(
        total.scalar().alias("record_count"),
        images.scalar().alias("image_count"),
        (images.scalar() == total.scalar() * len(ROLES)).alias("all_images_checked"),
        (total.scalar() - F.col("candidate_count")).alias("accepted_count"),
        "candidate_count",
        "duplicate_triplet_count",
        F.when(F.col("candidate_count") == 0, "pass").otherwise("candidates_excluded_from_acceptance").alias("status"),
    )


# --- ring audit ----------------------------------------------------------


def _digest(**fields: Column) -> Column:
    """32 bytes that are equal where all fields are, nulls included."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()])), 256))


def _bound_to(scene: Column, frame: Column, camera: Column, hashes: Column, roles: tuple[str, ...], **more: Column) -> Column:
    """Digest of what a ring's view and the record it comes from must share."""
    return _digest(scene=scene, frame=frame.cast("long"), camera=camera, **{r: hashes[r] for r in roles}, **more)


def group_errors(groups: DataFrame, sources: DataFrame, seen: DataFrame, canonical: DataFrame) -> DataFrame:
    """Sorted distinct error codes of every ring, empty when it is clean.

    ``sources`` are the audited records with their signature, ``seen`` the
    visibility masks and ``canonical`` the known asset ids.

    What a ring says about itself is judged where it lies. Only ids and digests are moved
    to the sources, and only asset lists to the visibility masks; hashes and file names
    stay.
    """
    names = dict(RING)
    order = F.array(*[F.lit(c) for c, _ in RING])
    none = F.array().cast("array<string>")
    selected = F.coalesce("selected_asset_ids", none)

    def usable(v: Column) -> Column:
        complete = F.lit(True)
        for r in ROLES:
            complete = complete & v["content_sha256"][r].isNotNull() & v["files"][r].isNotNull()
        return F.coalesce(v["camera_id"].isin(*names), F.lit(False)) & complete

    def applied(v: Column) -> Column:
        return F.coalesce(v["applied_asset_ids"], none)

    def of_view(v: Column) -> Column:
        name = F.element_at(F.create_map(*[F.lit(x) for pair in RING for x in pair]), v["camera_id"])
        known = F.coalesce(v["camera_id"].isin(*names), F.lit(False))
        hashes, edited = v["content_sha256"], is_true(v["asset_visible"])
        wrong_file, bad_hash = F.lit(False), F.lit(False)
        for r in ROLES:
            wrong_file = wrong_file | ~v["files"][r].eqNullSafe(role_file(F.col("group_id"), name, F.lit(r)))
            bad_hash = bad_hash | ~is_hash(hashes[r])
        unchanged = hashes["input"].eqNullSafe(hashes["target"])
        return codes(
            {
                "camera_name_mismatch": ~v["camera_name"].eqNullSafe(name),
                "role_membership_incomplete": known & ~usable(v),
                "flat_filename_mismatch": usable(v) & wrong_file,
                "visible_view_has_no_asset_pair": usable(v) & edited & (F.size(applied(v)) == 0),
                "visible_view_has_no_effective_edit": usable(v) & edited & unchanged,
                "invisible_view_was_edited": usable(v)
                & ~edited
                & ((F.size(applied(v)) > 0) | v["source_pair_sample_id"].isNotNull() | ~unchanged),
                "invalid_content_hash": usable(v) & bad_hash,
            }
        )

    identity = (
        blank(F.col("scene_name"))
        | (value_or(F.col("frame_index"), -1) < 0)
        | (F.size(selected) == 0)
        | (F.sort_array(F.array_distinct(selected)) != selected)
    )
    of_group = codes(
        {
            "record_binding_mismatch": text(F.col("record_sha256")) != ring_record_sha(),
            "invalid_group_identity": identity,
            "group_id_mismatch": F.col("group_id") != group_id(F.col("scene_name"), F.col("frame_index"), selected),
            "camera_ring_incomplete": ~F.coalesce(F.transform("views", lambda v: v["camera_id"]) == order, F.lit(False)),
        }
    )
    views = F.coalesce("views", F.array())
    own = groups.select("group_id", F.array_distinct(F.concat(of_group, F.flatten(F.transform(views, of_view)))).alias("found"))

    stranger = (
        groups.select("group_id", F.explode("selected_asset_ids").alias("asset_id"))
        .join(canonical.select("asset_id").distinct(), "asset_id", "left_anti")
        .select("group_id", F.lit("invalid_group_identity").alias("code"))
        .filter("group_id is not null")
    )

    shown = visible_by_camera(
        groups.select("scene_name", "frame_index", F.col("selected_asset_ids").alias("selected")).distinct(), seen
    ).select("scene_name", "frame_index", F.col("selected").alias("selected_asset_ids"), "visible")
    claims = F.transform(F.filter(views, usable), lambda v: F.struct(v["camera_id"].alias("camera"), applied(v).alias("applied")))
    expected = lambda c: F.coalesce(F.get("visible", (F.array_position(order, c["camera"]) - 1).cast("int")), none)
    hidden = (
        groups.select("group_id", "scene_name", "frame_index", "selected_asset_ids", claims.alias("claims"))
        .join(shown, ["scene_name", "frame_index", "selected_asset_ids"], "left")
        .filter(F.exists("claims", lambda c: c["applied"] != expected(c)))
        .select("group_id", F.lit("visibility_binding_mismatch").alias("code"))
    )

    v, place = F.col("v"), (F.col("scene_name"), F.col("frame_index"))
    baseline = F.struct(
        F.lit(True).alias("is_baseline"),
        v["baseline_sample_id"].alias("source_id"),
        _bound_to(*place, v["camera_id"], v["content_sha256"], ("gt", "target")).alias("claimed"),
    )
    pair = F.struct(
        F.lit(False).alias("is_baseline"),
        v["source_pair_sample_id"].alias("source_id"),
        _bound_to(*place, v["camera_id"], v["content_sha256"], ROLES, signature=applied(v)).alias("claimed"),
    )
    paired = is_true(v["asset_visible"]) & (F.size(applied(v)) > 0)
    asked = (
        groups.select("group_id", "scene_name", "frame_index", F.explode(F.filter(views, usable)).alias("v"))
        .select("group_id", F.explode(F.when(paired, F.array(baseline, pair)).otherwise(F.array(baseline))).alias("a"))
        .select("group_id", "a.*")
    )
    of_source = (*place, F.col("camera_id"), F.col("content_sha256"))
    stored = sources.select(
        F.col("sample_id").alias("source_id"),
        _bound_to(*of_source, ("gt", "target")).alias("_baseline"),
        _bound_to(*of_source, ROLES, signature=F.col("signature")).alias("_pair"),
    )
    is_baseline, absent = F.col("is_baseline"), F.col("_pair").isNull()
    differs = F.col("claimed") != F.when(is_baseline, F.col("_baseline")).otherwise(F.col("_pair"))
    unbound = asked.join(stored, "source_id", "left").select(
        "group_id",
        F.when(is_baseline & absent, "baseline_source_missing")
        .when(is_baseline & differs, "baseline_source_binding_mismatch")
        .when(~is_baseline & absent, "visible_view_has_no_asset_pair")
        .when(~is_baseline & differs, "pair_source_binding_mismatch")
        .alias("code"),
    ).filter("code is not null")

    flagged = own.select("group_id", F.explode_outer("found").alias("code")).unionByName(stranger).unionByName(hidden).unionByName(unbound)
    return flagged.groupBy("group_id").agg(F.sort_array(F.collect_set("code")).alias("errors"))


def ring_files(groups: DataFrame) -> DataFrame:
    """Every file a set of rings declares, with its hash."""
    per_role = F.array(
        *[F.struct(F.col(f"v.files.{r}").alias("name"), F.col(f"v.content_sha256.{r}").alias("expected")) for r in ROLES]
    )
    return (
        groups.select("group_id", F.explode("views").alias("v"))
        .select("group_id", F.explode(per_role).alias("f"))
        .select("group_id", "f.name", "f.expected")
        .filter(is_hash(F.col("expected")))
    )


def audit_rings(
    groups: DataFrame, sources: DataFrame, seen: DataFrame, canonical: DataFrame, files: DataFrame
) -> DataFrame:
    """All findings of a ring release: per group, per file, and for the folder.

    ``files`` holds ``name``, ``sha256`` and, where images were read, ``image_codes``.
    """
    by_group = group_errors(groups, sources, seen, canonical).filter(F.size("errors") > 0).select(
        F.col("group_id").alias("subject"), "errors"
    )
    has_codes = "image_codes" in files.columns
    declared = ring_files(groups).select("name", packed(F.col("expected")).alias("expected"))
    stored = files.select(
        "name",
        F.lit(True).alias("_listed"),
        F.col("sha256").isNull().alias("_irregular"),
        packed(F.col("sha256")).alias("_sha"),
        *(["image_codes"] if has_codes else []),
    )
    irregular, listed = F.coalesce("_irregular", F.lit(True)), F.col("_listed").isNotNull()
    differs = ~irregular & ~F.coalesce(F.col("_sha") == F.col("expected"), F.lit(False))
    found = codes({"not_regular_file": irregular, "hash_mismatch": differs})
    if has_codes:
        found = F.concat(found, F.coalesce("image_codes", F.array().cast("array<string>")))
    asked = F.col("expected").isNotNull()
    # One join tells the membership of the folder and the state of each file.
    looked_at = (
        declared.join(stored, "name", "full")
        .select("name", F.when(asked, F.sort_array(F.array_distinct(found))).alias("errors"), (asked & listed).alias("member"))
        .filter(~F.col("member") | (F.size("errors") > 0))
    )
    odd = staged(looked_at, "findings")
    folder = (
        odd.agg(F.count_if(~F.col("member")).alias("n"))
        .filter("n > 0")
        .select(F.lit("__release__").alias("subject"), F.array(F.lit("flat_png_membership_mismatch")).alias("errors"))
    )
    by_file = odd.filter(F.size("errors") > 0).select(F.col("name").alias("subject"), "errors")
    return by_group.unionByName(folder).unionByName(by_file)


def ring_audit_summary(groups: DataFrame, findings: DataFrame) -> DataFrame:
    total = groups.agg(F.count(F.lit(1)))
    checked = ring_files(groups).agg(F.count(F.lit(1)))
    images = len(RING) * len(ROLES)
    return findings.agg(F.count(F.lit(1)).alias("candidate_count")).select(
        F.when(F.col("candidate_count") == 0, "pass").otherwise("fail").alias("status"),
        total.scalar().alias("group_count"),
        (total.scalar() * images).alias("expected_image_count"),
        checked.scalar().alias("checked_image_count"),
        (checked.scalar() == total.scalar() * images).alias("all_images_checked"),
        "candidate_count",
    )


# --- batches of user work ------------------------------------------------


def run_windows(jobs: DataFrame, worker: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Hand a user's worker an iterator over the Arrow batches of one scene window at a time.

    The worker sees the whole window, ordered by sample_id, and yields batches; no more
    than a batch need be in memory, however many jobs a window has. What it leaves unread
    is skipped.
    """
    window = ["scene_name", "window_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from worker(batches)

    ordered = jobs.repartition(*window).sortWithinPartitions(*window, "sample_id")
    return ordered.groupBy(*window).applyInArrow(run, schema)


#: Types that pandas holds alike, whoever turns a frame into one.
_FLAT = (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.BinaryType)


def _windows(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table | None]:
    """The rows of one key after another, of rows in its order; None after each batch."""
    open_key, parts = None, []
    for batch in batches:
        start = 0
        for value, rows in groupby(zip(*(batch.column(k).to_pylist() for k in key))):
            if parts and value != open_key:
                yield pa.Table.from_batches(parts)
                parts = []
            count = sum(1 for _ in rows)
            parts.append(batch.slice(start, count))
            open_key, start = value, start + count
        yield None
    if parts:
        yield pa.Table.from_batches(parts)


def _framed(worker: Callable[[pd.DataFrame], pd.DataFrame], key: list[str], columns: list[str], made: pa.Schema) -> Callable:
    """``worker`` over the frames of all keys of a task; what they make goes on batch by batch."""

    def batch_of(frame: pd.DataFrame) -> pa.RecordBatch:
        if not any(isinstance(c, str) for c in frame.columns):
            frame = frame.set_axis(made.names[: frame.shape[1]], axis=1)
        cells = [pa.Array.from_pandas(frame[f.name], mask=frame[f.name].isnull(), type=f.type, safe=False) for f in made]
        return pa.RecordBatch.from_arrays(cells, schema=made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.RecordBatch] = []
        for rows in chain(_windows(batches, key), [None]):
            if rows is not None:
                frame = worker(rows.select(columns).to_pandas())
                done += [batch_of(frame)] if len(frame) else []
            elif done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []

    return run


def run_batches(
    jobs: DataFrame, worker: Callable[[pd.DataFrame], pd.DataFrame], schema: str, max_rows: int | None = None
) -> DataFrame:
    """Hand a user's worker the jobs of one scene window as one frame; :func:`run_windows` streams them.

    A worker that can take a window in parts may ask for ``max_rows``: windows of
    more jobs are then cut into about equal parts and spread over tasks.

    A task reads its windows as one stream and makes a frame of each: a stream for each
    window costs more than most workers do.
    """
    window = ["scene_name", "window_id"]
    if max_rows is None:
        placed = jobs.withColumns({"_part": F.lit(0), "_parts": F.lit(1)})
    else:
        parts = jobs.groupBy(*window).agg(F.ceil(F.count(F.lit(1)) / max_rows).cast("int").alias("_parts"))
        placed = jobs.join(parts, window).withColumn("_part", F.pmod(F.xxhash64("sample_id"), F.col("_parts")))
    key = [*window, "_part"]
    columns = jobs.columns

    ordered = placed.drop("_parts").repartition(*key).sortWithinPartitions(*key, "sample_id")
    kind = T._parse_datatype_string(schema)
    if all(isinstance(f.dataType, _FLAT) for f in [*jobs.schema, *kind]):
        return ordered.mapInArrow(_framed(worker, key, columns, to_arrow_schema(kind)), schema)

    # Times and nested values are left to Spark's own conversion, a group at a time.
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return worker(rows[columns])

    return ordered.groupBy(*key).applyInPandas(run, schema)
