"""Mixing of sources to target weights by temperature.

Source token shares p are raised to an exponent a and normalised: q ~ p**a. With a = 1
sources keep their shares, with a = 0 all weigh the same. The exponent is bisected to
the largest that reaches a target entropy, and is raised as far as a limit on the
repetition of any source asks. A source's part of the token budget is then realised: its
documents stand in a permuted order, whole epochs and then a beginning of one are
taken, and the stream is cut so that every block holds each source in its weight;
within a block rows are permuted.

Only DataFrame operations run. A large source is split to ranges of its permutation,
so its running token sum is taken over bounded ranges and their totals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairgrid.llm.common import query, table, whole_text
from pairgrid.session import staged

#: The exponent is a multiple of 2**-30; each pass over the sources settles five bits.
_GRID, _FAN = 30, 5


@dataclass(frozen=True)
class Target:
    """``evenness``: entropy as a part of the largest possible one. ``repetition``: epochs of any source at most.

    ``budget`` is in tokens (None: as many as there are), ``block_tokens`` the size of a
    block, ``range_rows`` the expected rows of a range of the permutation.
    """

    evenness: float | None = 0.97
    repetition: float | None = 4.0
    budget: int | None = None
    block_tokens: int = 1 << 20
    range_rows: int = 2_000
    seed: int = 7


def words(text: str = "text") -> Column:
    """Tokens of a text: runs of characters other than ASCII white space."""
    return F.regexp_count(whole_text(text), F.lit("[^ \\t\\n\\r\\f\\x0B]+")).cast("long")


def _at(sources: DataFrame, points: list[int], total: float) -> dict[int, tuple[float, float]]:
    """Entropy and largest q / p for each exponent, given as multiples of the grid."""
    p = F.col("tokens") / F.lit(total)
    a = F.col("point") / float(1 << _GRID)
    rows = (
        sources.select("tokens", F.explode(F.array([F.lit(x).cast("long") for x in points])).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.pow(p, a)).alias("z"), F.sum(F.pow(p, a) * F.log(p)).alias("s"), F.max(F.pow(p, a - 1)).alias("m"))
        .collect()
    )  # one row a point
    return {r["point"]: (math.log(r["z"]) - r["point"] / (1 << _GRID) * r["s"] / r["z"], r["m"] / r["z"]) for r in rows}


def _last(sources: DataFrame, total: float, holds) -> int:
    """Largest grid point at which ``holds(entropy, ratio)`` is still true; 0 if at none.

    ``holds`` is true up to some point and false after it.
    """
    top = 1 << _GRID
    if holds(*_at(sources, [top], total)[top]):
        return top
    low, step = 0, top
    while step > 1:
        step >>= _FAN
        points = [low + k * step for k in range(1, 1 << _FAN)]
        found = _at(sources, points, total)
        low = max([low, *(x for x in points if holds(*found[x]))])
    return low


def weights(sizes: DataFrame, target: Target = Target()) -> DataFrame:
    """source, rows, tokens, weight and quota of every source with tokens; ``sizes`` has source, rows, tokens.

    The exponent is the largest that reaches the evenness (1 where none is asked), or
    the smallest under the limit on repetition where that is larger: the limit wins.
    With a budget beyond that many epochs of all tokens the shares stay as they are.
    """
    sizes = sizes.where("tokens > 0")
    n, total = sizes.agg(F.count("*"), F.sum("tokens")).first()
    if not n:
        return sizes.select("source", "rows", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota"))
    budget, point = target.budget or total, 1 << _GRID
    if target.evenness is not None and n > 1:
        wanted = target.evenness * math.log(n)
        point = _last(sizes, float(total), lambda entropy, _: entropy >= wanted)
    if target.repetition is not None and point < 1 << _GRID:
        over = _last(sizes, float(total), lambda _, ratio: ratio * budget / total > target.repetition)
        fine = over == 0 and _at(sizes, [0], float(total))[0][1] * budget / total <= target.repetition
        point = max(point, 0 if fine else min(over + 1, 1 << _GRID))
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(point / (1 << _GRID)))
    scale = sizes.agg(F.sum(power)).first()[0]
    return sizes.select("source", "rows", "tokens", (power / F.lit(scale)).alias("weight")).withColumn(
        "quota", F.floor(F.col("weight") * F.lit(float(budget))).cast("long")
    )


def mix(docs: DataFrame, target: Target = Target(), doc_id: str = "doc_id", source: str = "source", tokens: Column | None = None) -> DataFrame:
    """Rows of ``docs`` as the mixture takes them, with mix_tokens, mix_copy, mix_block and mix_order.

    A row comes once for each epoch that reaches it, and mix_copy counts from 0. Reading
    blocks in order, and a block by mix_order, gives the stream. A row is taken where its
    first token lies within its source's quota. A null source is the empty string. Rows
    without tokens take part where their source has some; a source without any has
    weight 0. Repeated ids are rows of their own. All columns stay; those named as the four
    new ones are replaced. An empty table gives an empty table.
    """
    key = F.md5(F.concat_ws("/", F.lit(str(target.seed)), F.col(doc_id).cast("string")))
    rows = docs.withColumns({"__mix_source": F.coalesce(F.col(source).cast("string"), F.lit("")), "mix_tokens": words() if tokens is None else tokens, "__mix_key": key})
    sizes = staged(rows.groupBy(F.col("__mix_source").alias("source")).agg(F.count("*").alias("rows"), F.sum("mix_tokens").alias("tokens")), "sources")
    plan = staged(weights(sizes, target), "weights")
    budget = plan.agg(F.sum("quota")).first()[0] or 0
    blocks = max(1, -(-budget // target.block_tokens))
    info = plan.select(
        F.col("source").alias("__mix_source"),
        F.col("tokens").alias("__mix_all"),
        F.col("quota").alias("__mix_quota"),
        F.ceil(F.col("rows") / target.range_rows).cast("long").alias("__mix_ranges"),
    )
    place = F.conv(F.substring("__mix_key", 1, 8), 16, 10).cast("long")
    ranged = rows.join(info, "__mix_source").withColumn("__mix_range", F.shiftright(place * F.col("__mix_ranges"), 32))
    # Totals come from the narrow columns; the rows themselves move once, to their range.
    totals = ranged.groupBy("__mix_source", "__mix_range").agg(F.sum("mix_tokens").alias("__mix_sum"))
    before = Window.partitionBy("__mix_source").orderBy("__mix_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(totals.select("__mix_source", "__mix_range", F.coalesce(F.sum("__mix_sum").over(before), F.lit(0)).alias("__mix_base")), "ranges")
    inside = Window.partitionBy("__mix_source", "__mix_range").orderBy("__mix_key", doc_id).rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum("mix_tokens").over(inside) - F.col("mix_tokens")
    at = ranged.withColumn("__mix_start", run).join(bases, ["__mix_source", "__mix_range"])
    start = F.col("__mix_base") + F.col("__mix_start")
    copies = F.ceil((F.col("__mix_quota") - start) / F.col("__mix_all")).cast("int")
    taken = at.where(start < F.col("__mix_quota")).withColumn("mix_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    offset = start + F.col("mix_copy") * F.col("__mix_all")
    block = F.least(F.floor(offset / (F.col("__mix_quota") / F.lit(float(blocks)))).cast("long"), F.lit(blocks - 1).cast("long"))
    new = ["mix_tokens", "mix_copy", "mix_block", "mix_order"]
    out = taken.withColumns({"mix_block": block, "mix_order": F.md5(F.concat_ws("/", "__mix_key", F.col("mix_copy").cast("string")))})
    return out.select(*[c for c in docs.columns if c not in new], *new)


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, md5('7/' || doc_id) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+')) AS n
  FROM documents),
s AS (SELECT source, sum(n)::DOUBLE AS t FROM d GROUP BY 1 HAVING sum(n) > 0),
p AS (SELECT source, t, t / (SELECT sum(t) FROM s) AS p FROM s),
steps(k, even, over) AS (
  SELECT 30, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT k - 1,
    CASE WHEN (SELECT ln(sum(pow(p, (even + (1 << (k - 1))) / 1073741824.0::DOUBLE)))
                 - (even + (1 << (k - 1))) / 1073741824.0::DOUBLE
                   * sum(pow(p, (even + (1 << (k - 1))) / 1073741824.0::DOUBLE) * ln(p))
                   / sum(pow(p, (even + (1 << (k - 1))) / 1073741824.0::DOUBLE)) FROM p)
              >= 0.97 * ln((SELECT count(*) FROM p)) THEN even + (1 << (k - 1)) ELSE even END,
    CASE WHEN (SELECT max(pow(p, (over + (1 << (k - 1))) / 1073741824.0::DOUBLE - 1))
                   / sum(pow(p, (over + (1 << (k - 1))) / 1073741824.0::DOUBLE)) FROM p) > 4.0
         THEN over + (1 << (k - 1)) ELSE over END
  FROM steps WHERE k > 0),
ends AS (SELECT even, over FROM steps WHERE k = 0),
a AS (
  SELECT CASE WHEN (SELECT -sum(p * ln(p)) FROM p) >= 0.97 * ln((SELECT count(*) FROM p)) THEN 1.0::DOUBLE
         ELSE greatest(even, CASE WHEN over = 0 AND (SELECT max(1 / p) / count(*) FROM p) <= 4.0 THEN 0 ELSE over + 1 END)
              / 1073741824.0::DOUBLE END AS a FROM ends),
w AS (SELECT source, t, floor(pow(p, a) / (SELECT sum(pow(p, a)) FROM p, a) * (SELECT sum(t) FROM s)) AS quota FROM p, a),
b AS (SELECT greatest(1, ceil(sum(quota) / 1048576)) AS blocks FROM w),
o AS (
  SELECT d.*, t, quota, sum(n) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - n AS start
  FROM d JOIN w ON d.source = w.source),
c AS (
  SELECT *, unnest(range(0, ceil((quota - start) / t)::BIGINT)) AS copy FROM o WHERE start < quota),
x AS (
  SELECT *, least(floor((start + copy * t) / (quota / blocks)), blocks - 1)::BIGINT AS block, md5(h || '/' || copy) AS mixed
  FROM c, b)
SELECT doc_id, source, n AS n_tokens, copy::INT AS copy, block,
       row_number() OVER (PARTITION BY block ORDER BY mixed, doc_id) AS position
FROM x
"""


@query("op7_temperature_mixing", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, copy, block and position of every row of the mixture."""
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs.select("doc_id", "source", words().alias("n")), tokens=F.col("n"))
    order = Window.partitionBy("mix_block").orderBy("mix_order", "doc_id")
    return mixed.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_copy").alias("copy"),
        F.col("mix_block").alias("block"),
        F.row_number().over(order).cast("long").alias("position"),
    )
