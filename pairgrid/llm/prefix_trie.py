"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a sequence of turns. It is named by a sum of one hash for each place and turn,
so names of all prefixes of a conversation are running sums, and a conversation of any
length is summed in blocks that may lie on different machines.

Totals of subtrees don't climb the tree level by level, as a long conversation is a path
as deep as it is long. The forest of parent edges is split instead: the centroid of a
component is its deepest node whose subtree holds at least half of it. Without the
centroid there are pieces below it and one above, none larger than half. What lies in
and below the centroid is summed once and added to every node on the path from the
centroid to the component's top; then each piece is a component of its own. After as
many rounds as the size has binary digits every node has the sum of its subtree.

In a trie the path from a node upward is a part of any conversation through it, so the
rows of the smallest such conversation are that path and no pointer is chased. Components
of bounded size are decomposed by the same steps within a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairgrid.llm.common import query, table
from pairgrid.session import staged

#: Names of nodes are three sums modulo 2**40; a block's running sums stay below 2**63.
_LANES, _BITS, _BLOCK = ("k1", "k2", "k3"), 40, 1 << 12
#: The empty sum.
_ROOT = "0" * (_BITS // 4 * len(_LANES))
#: Ids of a node's ending members that are joined to one text.
_IDS_A_PIECE = 1 << 16


def _hex40(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), _BITS // 4, "0")


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, at (from 1), digest of role and text, and n_bytes of the text, of each turn.

    Turns go by ``turn``, nulls first, and equal ones by their digests. Rows are dealt in
    ranges, so one conversation may lie in many tasks: a task numbers its own rows, and
    what lies in the tasks before it is added. Rows without a conversation are left out.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256).alias("digest"),
        F.octet_length(said).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = rows.repartitionByRange("conv_id", "turn", "digest", "place").sortWithinPartitions("conv_id", "turn", "digest")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for conv in batch.column("conv_id").to_pylist():
                n = n + 1 if conv == last else 1
                last = conv
                at.append(n)
            columns = [batch.column("conv_id"), pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64()), batch.column("digest"), batch.column("n_bytes")]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "at", "digest", "n_bytes"])

    placed = staged(ordered.mapInArrow(count, "conv_id long, part int, at long, digest string, n_bytes long"), "numbered")
    by_part = placed.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # Only a range's first conversation can have begun before it: at most one row a task.
    begun = by_part.withColumn("before", before).where(F.col("before") > 0).select("conv_id", "part", "before")
    joined = placed.join(F.broadcast(begun), ["conv_id", "part"], "left")
    return joined.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "digest", "n_bytes")


def rebuilt(turns: DataFrame, shared: Column, source: Column) -> DataFrame:
    """Conversations that begin with turns of another one: conv_id, at, digest, n_bytes.

    ``turns`` is what ``numbered`` gives. The first ``shared`` turns of conversation
    ``source`` (all it has, or none if there is no such one) take the place of as many
    own turns; both are expressions of conv_id. ``shared`` is at most 8.
    """
    ids = turns.groupBy("conv_id").agg(F.max("at").alias("n"))
    wanted = ids.select("conv_id", shared.cast("long").alias("h"), source.alias("source"))
    known = ids.select(F.col("conv_id").alias("source"), F.col("n").alias("n_source"))
    has = wanted.join(known, "source", "left").withColumn("taken", F.least("h", F.coalesce("n_source", F.lit(0))))
    heads = turns.where(F.col("at") <= 8).select(F.col("conv_id").alias("source"), "at", "digest", "n_bytes")
    borrowed = has.where(F.col("taken") > 0).join(heads, "source").where(F.col("at") <= F.col("taken")).select("conv_id", "at", "digest", "n_bytes")
    own = turns.where(F.col("at") > shared).join(has.select("conv_id", "h", "taken"), "conv_id")
    kept = own.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "n_bytes")
    return borrowed.unionByName(kept)


def paths_of(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent and n_bytes of every prefix of every conversation.

    ``conversations`` has the conv_id of each, also of those without a turn; each has a
    row of depth 0 for the root.
    """
    mask, modulus = (1 << _BITS) - 1, F.lit(1 << _BITS)
    rows = turns.select(
        "conv_id",
        F.col("at").alias("depth"),
        F.floor((F.col("at") - 1) / _BLOCK).alias("block"),
        "n_bytes",
        *(F.xxhash64("at", "digest", F.lit(k)).bitwiseAND(F.lit(mask)).alias(k) for k in _LANES),
    )
    running = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("conv_id", "block", "depth", "n_bytes", *_LANES, *(F.sum(k).over(running).alias(f"r_{k}") for k in _LANES))
    blocks = rows.groupBy("conv_id", "block").agg(*(F.sum(k).alias(k) for k in _LANES))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.select("conv_id", "block", *(F.pmod(F.sum(F.pmod(k, modulus)).over(earlier), modulus).alias(f"b_{k}") for k in _LANES))
    whole = summed.join(begun.where(F.col("block") > 0), ["conv_id", "block"], "left")
    name = {k: F.pmod(F.col(f"r_{k}") + F.coalesce(F.col(f"b_{k}"), F.lit(0)), modulus) for k in _LANES}
    named = whole.select(
        "conv_id",
        "depth",
        F.concat(*(_hex40(name[k]) for k in _LANES)).alias("node"),
        F.concat(*(_hex40(F.pmod(name[k] - F.col(k), modulus)) for k in _LANES)).alias("parent"),
        "n_bytes",
    )
    zero = F.lit(0).cast("long")
    tops = conversations.select("conv_id", zero.alias("depth"), F.lit(_ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), zero.alias("n_bytes"))
    return named.unionByName(tops)


def subtree_sizes(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """node and size, the number of nodes in its subtree.

    The nodes whose smallest member is the same lie below one another at the end of that
    conversation, so each of its rows knows how many of them are below it.
    """
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max("depth").alias("last"))
    below = F.col("last") - F.greatest("first", "depth") + 1
    return paths.join(owned, "conv_id").groupBy("node").agg(F.sum(below).alias("size"))


def local_rollup(parent: list[int], size: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of whole components by centroid decomposition.

    ``parent`` is the place of a row's parent, which comes before it, or -1 for a top;
    ``size`` counts its subtree; each list of ``values`` is summed. ``size`` is changed.
    """
    top: list[int] = []
    for v, p in enumerate(parent):
        top.append(v if p < 0 else top[p])
    totals = [list(x) for x in values]
    alive: list[int] = list(range(len(parent)))
    while alive:
        centroid = {top[v]: v for v in alive if 2 * size[v] >= size[top[v]]}  # the last one is the deepest
        sums = {c: [0] * len(values) for c in centroid.values()}
        piece: dict[int, int] = {}
        below: set[int] = set()
        for v in alive:
            t, p = top[v], parent[v]
            c = centroid[t]
            if v == c or (v != t and p in below):
                below.add(v)
                for k, x in enumerate(values):
                    sums[c][k] += x[v]
            if v != c:
                piece[v] = v if v == t or p == c else piece[p]
        for t, c in centroid.items():
            for k, s in enumerate(sums[c]):
                totals[k][c] += s - values[k][c]
            u = c
            while u != t:
                u = parent[u]
                size[u] -= size[c]
                for k, s in enumerate(sums[c]):
                    totals[k][u] += s
        for v, t in piece.items():
            top[v] = t
        alive = [v for v in alive if v in piece]
    return totals


def _decomposed(names: tuple[str, ...], held: int):
    """Rows by (top, depth) to node and subtree sums, some whole components at a time."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        ids = rows.column("node").to_pylist()
        at = {x: k for k, x in enumerate(ids)}
        top = rows.column("top").to_pylist()
        parent = [-1 if x == t else at[p] for x, t, p in zip(ids, top, rows.column("parent").to_pylist())]
        values = [rows.column(n).to_pylist() for n in names]
        found = local_rollup(parent, rows.column("size").to_pylist(), values)
        sums = [[t - v + a for t, v, a in zip(x, y, rows.column(f"sum_{n}").to_pylist())] for n, x, y in zip(names, found, values)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), *(pa.array(x, pa.int64()) for x in sums)], names=["node", *(f"sum_{n}" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= held:
                rows = pa.Table.from_batches(waiting)
                top = rows.column("top").to_pylist()
                cut = len(top)
                while cut and top[cut - 1] == top[-1]:
                    cut -= 1
                if cut:
                    yield solve(rows.slice(0, cut))
                    waiting = rows.slice(cut).to_batches()
        if waiting:
            yield solve(pa.Table.from_batches(waiting))

    return run


def rollup(nodes: DataFrame, paths: DataFrame, values: tuple[str, ...], local_nodes: int = 20_000) -> DataFrame:
    """node and ``sum_<value>`` over its subtree, for long columns ``values`` of ``nodes``.

    ``nodes`` is one tree with its root at depth 0: node, parent, depth and conv_id, one conversation through it whose rows
    in ``paths`` (conv_id, depth, node, parent) are the way up. Components of up to
    ``local_nodes`` nodes are decomposed within a task; the others are split in rounds.
    """
    state = nodes.join(subtree_sizes(nodes, paths), "node").select(
        *("node", "parent", "conv_id", "depth", "size"),
        F.lit(_ROOT).alias("top"),
        F.lit(0).cast("long").alias("top_depth"),
        *values,
        *(F.col(v).alias(f"sum_{v}") for v in values),
    )
    state = staged(state, "trie-state")
    names = [f"sum_{v}" for v in values]
    done: list[DataFrame] = []
    columns = state.columns
    while True:
        sizes = state.groupBy("top").agg(F.max("size").alias("all"))
        large = sizes.where(F.col("all") > local_nodes)
        if large.isEmpty():
            break
        split = state.join(large, "top")
        deepest = F.max_by(F.struct("node", "conv_id", "depth", "size"), "depth")
        centroids = staged(
            split.where(2 * F.col("size") >= F.col("all")).groupBy("top", "top_depth").agg(deepest.alias("c")).select("top", "top_depth", *(F.col(f"c.{x}").alias(f"c_{x}") for x in ("node", "conv_id", "depth", "size"))),
            "centroids",
        )
        # Below a centroid? Then a row's own way up passes it, and the next node on that way is its piece.
        asked = state.join(centroids.drop("top_depth"), "top")
        way = paths.select("conv_id", F.col("depth").alias("w_depth"), F.col("node").alias("w_node"), F.col("parent").alias("w_parent"))
        deeper = asked.where(F.col("depth") > F.col("c_depth")).withColumn("w_depth", F.col("c_depth") + 1).join(way, ["conv_id", "w_depth"])
        is_below = F.col("w_parent") == F.col("c_node")
        high = asked.where(F.col("depth") <= F.col("c_depth"))
        lower = deeper.where(is_below)
        beside = deeper.where(~is_below).unionByName(high, allowMissingColumns=True)
        marked = staged(
            lower.select(*columns, "c_node", F.col("w_node").alias("piece"), (F.col("c_depth") + 1).alias("piece_depth")).unionByName(
                beside.select(*columns, "c_node", F.when(F.col("node") != F.col("c_node"), F.col("top")).alias("piece"), F.col("top_depth").alias("piece_depth"))
            ),
            "pieces",
        )
        inside = F.col("piece").isNull() | (F.col("piece") != F.col("top"))
        weights = marked.where(inside).groupBy("top").agg(*(F.sum(v).alias(f"c_{v}") for v in values))
        weighed = staged(centroids.join(weights, "top"), "totals")
        up = weighed.join(paths.select(F.col("conv_id").alias("c_conv_id"), "depth", "node"), "c_conv_id")
        up = up.where((F.col("depth") >= F.col("top_depth")) & (F.col("depth") < F.col("c_depth"))).select("node", "c_size", *(f"c_{v}" for v in values))
        own = weighed.select(F.col("c_node").alias("node"), F.lit(0).cast("long").alias("c_size"), *(f"c_{v}" for v in values))
        added = marked.join(up.unionByName(own), "node", "left")
        zero = F.lit(0).cast("long")
        # The centroid's own value is in its sum already.
        extra = {v: F.coalesce(F.col(f"c_{v}"), zero) - F.when(F.col("piece").isNull(), F.col(v)).otherwise(zero) for v in values}
        moved = added.select(
            *("node", "parent", "conv_id", "depth"),
            (F.col("size") - F.coalesce("c_size", zero)).alias("size"),
            F.col("piece").alias("top"),
            F.col("piece_depth").alias("top_depth"),
            *values,
            *((F.col(f"sum_{v}") + extra[v]).alias(f"sum_{v}") for v in values),
        )
        moved = staged(moved.unionByName(state.join(large, "top", "left_anti").select(*columns)), "trie-state")
        done.append(moved.where(F.col("top").isNull()).select("node", *names))
        state = moved.where(F.col("top").isNotNull())
    ordered = state.repartition("top").sortWithinPartitions("top", "depth")
    kind = ", ".join(["node string", *(f"{n} long" for n in names)])
    out = ordered.mapInArrow(_decomposed(values, local_nodes), kind)
    for more in done:
        out = out.unionByName(more)
    return out


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's ids as texts of at most ``_IDS_A_PIECE`` ids."""
    held: list[tuple] = []
    node, ids = None, []
    for batch in batches:
        for x, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (x != node or len(ids) >= _IDS_A_PIECE):
                held.append((node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = x
            ids.append(conv)
        if held:
            yield _table(held, [pa.string(), pa.int64(), pa.string()], ["node", "first", "ids"])
            held = []
    if ids:
        yield _table([(node, ids[0], ",".join(map(str, ids)))], [pa.string(), pa.int64(), pa.string()], ["node", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of texts of a node."""
    node, sha = None, None
    for batch in batches:
        found = []
        for x, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
            if sha is not None and x == node:
                sha.update(b",")
            else:
                if sha is not None:
                    found.append((node, sha.hexdigest()))
                node, sha = x, hashlib.sha256()
            sha.update(ids.as_py().encode())
        if found:
            yield _table(found, [pa.string(), pa.string()], ["node", "ends_sha256"])
    if sha is not None:
        yield _table([(node, sha.hexdigest())], [pa.string(), pa.string()], ["node", "ends_sha256"])


def _table(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def ending_digests(ends: DataFrame) -> DataFrame:
    """node and ends_sha256, the digest of the ascending ids that end there; ``ends`` has node and conv_id.

    A digest needs its ids in order in one place, however many they are. They are joined
    to texts in ranges first, so the task that reads a node's ids reads few rows, and
    neither task holds more than one text.
    """
    ranges = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    texts = ranges.mapInArrow(_id_texts, "node string, first long, ids string")
    ordered = texts.repartition("node").sortWithinPartitions("node", "first")
    return ordered.mapInArrow(_digests, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, local_nodes: int = 20_000) -> DataFrame:
    """One row for each node of the trie of ``turns`` (conv_id, at, digest, n_bytes).

    conv_id is the node's smallest member and parent_conv_id its parent's (null at the
    root); n_convs counts members, n_children the nodes one turn longer, n_leaves the
    nodes without children in its subtree; saved_tokens sums over the subtree a node's
    other members times the bytes of its last text; ends_sha256 digests the members
    that end here. Members of the root are all ``conversations``. Without any there is
    no row.
    """
    paths = staged(paths_of(turns, conversations), "paths")
    grouped = paths.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.first("n_bytes").alias("n_bytes"),
    )
    grouped = staged(grouped, "grouped")
    children = grouped.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = grouped.join(children, "node", "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
            "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("n_bytes"),
        }
    )
    nodes = staged(nodes, "nodes")
    sums = rollup(nodes, paths, ("leaves", "saved"), local_nodes)
    ends = ending_digests(paths.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node")).select("node", "conv_id"))
    # Most nodes may lie right below the root, whose smallest member is the smallest of all.
    first = nodes.where(F.col("depth") == 0).select(F.col("conv_id").alias("root_conv_id"))
    inner = nodes.where(F.col("n_children") > 0).where(F.col("depth") > 0).select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    high = nodes.where(F.col("depth") <= 1).join(F.broadcast(first)).withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("root_conv_id")))
    deep = nodes.where(F.col("depth") > 1).join(inner, "parent")
    named = high.select(*nodes.columns, "parent_conv_id").unionByName(deep.select(*nodes.columns, "parent_conv_id"))
    return named.join(sums, "node").join(ends, "node", "left").select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children"),
        F.col("sum_leaves").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def shared_turns() -> Column:
    """How many turns a conversation takes over in the query: crc32 of its id, modulo 9."""
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9


_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
OP11_SQL = f"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % 9 AS h, conv_id - conv_id % 5 AS source FROM (SELECT DISTINCT conv_id FROM o)),
t AS (
  SELECT c.conv_id, o.pos, o.role, o.text FROM c JOIN o ON o.conv_id = c.source AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.pos + 1000000, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS n_bytes,
    md5(string_agg(sha256(length(role) || ':' || role || text), '' ) OVER w) AS node
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
        depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM p),
n AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * any_value(n_bytes) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
      FROM q GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
s AS (SELECT q.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
      FROM n JOIN q ON q.conv_id = n.conv_id AND q.depth <= n.depth LEFT JOIN k ON k.node = n.node GROUP BY q.node)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  s.n_leaves, s.saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n m ON m.node = n.parent
"""


@query("op11_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, each rebuilt to begin with turns of another one."""
    turns = staged(numbered(table(spark, sf_dir, "conversations")), "turns")
    again = rebuilt(turns, shared_turns(), F.col("conv_id") - F.col("conv_id") % 5)
    return prefix_trie(again, turns.select("conv_id").distinct())
