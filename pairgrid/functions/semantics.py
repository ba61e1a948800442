"""Column helpers which fix the value semantics every rule relies on.

Missing and empty text count as the same thing, flags are true only when they
are the boolean true, NaN never passes a lower bound, and rules report codes
rather than raise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the data format.
ROLES = ("gt", "input", "target")
CAMERAS = ("0", "1", "2", "3", "4", "5")
IMAGE_WIDTH, IMAGE_HEIGHT = 512, 288
# Ring order, clockwise from the front.
RING = (
    ("0", "CAM_FRONT"),
    ("2", "CAM_FRONT_RIGHT"),
    ("4", "CAM_BACK_RIGHT"),
    ("5", "CAM_BACK"),
    ("3", "CAM_BACK_LEFT"),
    ("1", "CAM_FRONT_LEFT"),
)
FORWARD_AXIS = "+X"
HASH_LENGTH = 64


def text(c: Column) -> Column:
    """Text with null read as empty."""
    return F.coalesce(c, F.lit(""))


def blank(c: Column) -> Column:
    return text(c) == ""


def first_text(*cs: Column) -> Column:
    """First non-empty value, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def not_true(c: Column) -> Column:
    return ~is_true(c)


def value_or(c: Column, default: float | int) -> Column:
    """The default replaces null only."""
    return F.coalesce(c, F.lit(default))


def nonzero_or(c: Column, default: float | int) -> Column:
    """The default replaces null and zero."""
    return F.coalesce(F.nullif(c, F.lit(0).cast("double")), F.lit(default))


def at_least(c: Column, limit: Column) -> Column:
    """``c >= limit`` that NaN does not pass (Spark orders NaN above all numbers)."""
    return ~F.isnan(c) & (c >= limit)


def finite(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def is_hash(c: Column) -> Column:
    return F.length(text(c)) == HASH_LENGTH


def packed(c: Column) -> Column:
    """Text as bytes, a hash of 64 hex digits as 33 of them; equal where the texts are, and null where it is."""
    plain = F.concat(F.unhex(F.lit("00")), c.cast("binary"))
    return F.when(c.rlike("^[0-9a-f]{64}\\z"), F.concat(F.unhex(F.lit("01")), F.unhex(c))).otherwise(plain)


def unpacked(c: Column) -> Column:
    """The text that :func:`packed` was given."""
    body = F.substring(c, F.lit(2), F.length(c))
    return F.when(F.substring(c, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(body))).otherwise(body.cast("string"))


def codes(rules: Mapping[str, Column]) -> Column:
    """Array of the codes whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in rules.items()]))


def sorted_set(c: Column) -> Column:
    return F.sort_array(F.array_distinct(c))


def nonempty_sorted_set(c: Column) -> Column:
    """Sorted distinct ids; one missing id, or none at all, gives the empty list."""
    none = F.array().cast("array<string>")
    return F.when(F.exists(c, lambda v: blank(v)), none).otherwise(F.coalesce(sorted_set(c), none))


def require_empty(violations: DataFrame, message: str, shown: int = 5) -> None:
    """Strict mode: raise when a violation table holds any row, quoting a few."""
    rows = violations.limit(shown).collect()
    if rows:
        raise ValueError(f"{message}: " + "; ".join(str(r.asDict(recursive=True)) for r in rows))


def padded(number: Column, width: int) -> Column:
    """Decimal text of a natural number, ``width`` digits or as many as it needs."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def window_name(frame: Column) -> Column:
    return F.concat(F.lit("w"), padded(frame, 6))


def frame_name(frame: Column) -> Column:
    return F.concat(F.lit("f"), padded(frame, 3))


def split_view_key(key: Column) -> tuple[Column, Column]:
    """``"000013:c0"`` to (13, "0"), cut at the first mark."""
    parts = F.split(key, ":c", 2)
    return parts.getItem(0).try_cast("int"), parts.getItem(1)


def lwh_from_wlh(c: Column) -> Column:
    """Width-length-height to length-width-height; anything but three values gives none."""
    return F.when(F.size(c) == 3, F.array(c.getItem(1), c.getItem(0), c.getItem(2))).otherwise(
        F.array().cast("array<double>")
    )


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def role_file(group_id: Column, camera_name: Column, role: Column) -> Column:
    return F.concat(F.concat_ws("__", group_id, camera_name, role), F.lit(".png"))


def to_byte(c: Column) -> Column:
    """Unit range to 0..255: clip, then round half to even."""
    return F.rint(F.least(F.lit(255.0), F.greatest(F.lit(0.0), c * 255.0))).cast("int")


def utc_stamp(at: Column | None = None, fraction: bool = False) -> Column:
    """An instant (now, where none is given) as a UTC stamp, with microseconds if asked for.

    A year beyond 9999 has as many digits as it needs and no sign before them.
    """
    now = F.current_timestamp() if at is None else at
    stamp = F.date_format(F.to_utc_timestamp(now, F.current_timezone()), f"yyyyMMdd'T'HHmmss{'SSSSSS' if fraction else ''}'Z'")
    return F.ltrim(stamp, F.lit("+"))


def camera_bit(camera: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), camera.try_cast("int"))


def cameras_in(mask: Column) -> Column:
    """Sorted camera ids whose bit is set."""
    return F.array_compact(
        F.array(*[F.when(mask.bitwiseAND(F.lit(1 << int(c))) != 0, F.lit(c)) for c in CAMERAS])
    )


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are empty or occur more than once."""
    empty = F.lit(False)
    for k in keys:
        empty = empty | blank(F.col(k).cast("string"))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(empty | (F.col("row_count") > 1))
    )
