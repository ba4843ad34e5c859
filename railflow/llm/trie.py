"""Operator 12, conversation prefix trie: rollup by centroid decomposition.

Every distinct sequence of a conversation's first d turns is a node; its parent is
the sequence without the last turn.  Nodes are named by a digest of exact prefix sums
of (position, turn) hashes, so a prefix is named without gathering its turns: long
conversations are cut into blocks of positions, and blocks meet by their sums.

Subtree totals come from a **centroid decomposition** of the parent-edge forest.  A
node weighs as many rows as it has members, so the weight of its whole subtree is
known at once (the turns that its members still have).  Of a component, the nodes
whose subtree outweighs half of it form the path from its top to its centroid, the
deepest of them.  The centroid's subtree total is its own value and the totals of the
components below it; it is added to every node on that path; then the component falls
apart into the part above and one part below each child of the centroid, none heavier
than half of it.  So the rounds grow with the logarithm of the rows and not with the
depth: a single conversation of millions of turns rolls up like a star.  A node finds
its part by one lookup: the turn after the centroid's depth in a conversation that
passes through it.  Components of at most ``LOCAL`` rows are finished in the task that
holds them.

Numbers of turns, prefix sums and rounds never put a whole conversation, node or
component of unbounded size into one task.  The digest of a node's ending
conversations is a sequential hash: ids are joined to texts of at most ``IDS`` ids in
parallel, and one stream per node hashes these.

Defined results: null roles and texts are empty; rows without a conv_id belong to no
conversation; turns that are equal in ``turn`` are ordered by a digest of role and text
(so no text is shuffled), repeated rows are turns of their own; an empty table gives no rows, not even a root;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railflow.llm.common import ship, stage, unstage
from railflow.llm.ranking import running_start

LOCAL = 20_000     # rows of a component that one task finishes
BLOCK = 1024       # positions of a conversation whose hashes are summed in one window
IDS = 4096         # conversation ids joined to one text before they are hashed
KEPT_TURNS = 8     # longest shared beginning of the rebuilt conversations

SUMS = ["s0", "s1", "s2", "s3"]


def numbered(conversations: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(conv_id, at, n, digest, n_bytes): every turn with its place (from 0), the
    number of turns, the digest of role and text and the bytes of its text; and the
    staged tables that this reads."""
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("rid"))
    rows = stage(spark, rows, "trie-turns")
    order = [F.col("turn").asc_nulls_first(), F.col("digest").asc(), F.col("rid").asc()]
    cut = stage(spark, rows.repartitionByRange(F.col("conv_id").asc(), *order).withColumn(
        "block", F.spark_partition_id()), "trie-blocks")
    out = running_start(cut, ["conv_id"], F.col("block"), order, F.lit(1), "at", "n")
    return out.select("conv_id", "at", "n", "digest", "n_bytes"), [rows, cut]


def shared_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: the first h turns of conversation c - c % 5, then
    c's own turns after its first h, where h = crc32(c) % 9.  Returns their rows
    (conv_id, pos from 1, length, digest, n_bytes) and all of them (conv_id, length)."""
    convs = turns.groupBy("conv_id").agg(F.max("n").alias("n")).withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % (KEPT_TURNS + 1),
        "base": F.col("conv_id") - F.col("conv_id") % 5})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    heads = turns.where(F.col("at") < KEPT_TURNS).withColumnRenamed("conv_id", "base").drop("n")
    first = heads.join(convs.select("conv_id", "base", "h", "length"), "base").where("at < h").select(
        "conv_id", (F.col("at") + 1).alias("pos"), "length", "digest", "n_bytes")
    own = turns.drop("n").join(convs.select("conv_id", "h", "shared", "length"), "conv_id").where("at >= h").select(
        "conv_id", (F.col("shared") + F.col("at") - F.col("h") + 1).alias("pos"), "length", "digest", "n_bytes")
    return first.unionByName(own), convs.select("conv_id", "length")


def _name(depth: Column, sums: list[Column]) -> Column:
    return F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]))


def root_name() -> Column:
    return _name(F.lit(0), [F.lit(0)] * len(SUMS))


def places_of(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, length, node, parent, n_bytes): the node of every turn."""
    def halves(salt: int) -> list[Column]:
        both = F.xxhash64(F.lit(salt), "pos", "digest")
        return [F.shiftrightunsigned(both, 32), both.bitwiseAND(F.lit(0xFFFFFFFF))]
    parts = [*halves(1), *halves(2)]
    rows = rows.withColumns({f"m{i}": p for i, p in enumerate(parts)})
    rows = rows.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(f"m{i}").alias(f"b{i}") for i in range(len(SUMS))])
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.sum(f"b{i}").over(before), F.lit(0)).alias(f"b{i}")
                                                 for i in range(len(SUMS))])
    rows = rows.withColumns({s: F.sum(f"m{i}").over(inside) for i, s in enumerate(SUMS)})
    rows = rows.join(blocks, ["conv_id", "block"])
    upto = [F.col(s) + F.col(f"b{i}") for i, s in enumerate(SUMS)]
    above = [u - F.col(f"m{i}") for i, u in enumerate(upto)]
    return rows.select("conv_id", "pos", "length", _name(F.col("pos"), upto).alias("node"),
                       _name(F.col("pos") - 1, above).alias("parent"), "n_bytes")


def nodes_of(places: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: smallest member, depth, parent, members, bytes of the last
    text, weight (turns from here on of all members) and children."""
    left = F.col("length") - F.col("pos") + 1
    nodes = places.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.min("parent").alias("parent"),
        F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"), F.sum(left).alias("weight"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                     F.sum(F.col("length") + 1).alias("weight")).where("n_convs > 0").select(
        root_name().alias("node"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"),
        "n_convs", F.lit(0).cast("long").alias("n_bytes"), "weight")
    nodes = nodes.unionByName(root)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    return nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def settle(parent: list[int], weight: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Subtree totals of one component in memory.  Nodes come by depth, the top first;
    ``parent`` holds places in the lists (-1: outside), ``weight`` subtree weights."""
    weight, width = weight[:], range(len(values[0]))
    found = [[0] * len(width) for _ in parent]
    open_parts = [[*range(len(parent))]]
    while open_parts:
        part = open_parts.pop()
        half = weight[part[0]]
        path = [u for u in part if 2 * weight[u] > half]
        centre = path.pop()
        total, top_of = list(values[centre]), {}
        above: list[int] = []
        below: dict[int, list[int]] = {}
        for u in part:
            if u == centre:
                continue
            top = u if parent[u] == centre else top_of.get(parent[u])
            if top is None:
                above.append(u)
                continue
            top_of[u] = top
            below.setdefault(top, []).append(u)
            for i in width:
                total[i] += values[u][i]
        for u in (centre, *path):
            for i in width:
                found[u][i] += total[i]
        for u in path:
            weight[u] -= weight[centre]
        open_parts += below.values()
        if above:
            open_parts.append(above)
    return found


def _finish(values: list[str]):
    """Arrow function over rows sorted by (component, depth): settles each component."""
    def one(rows: list[tuple]) -> Iterator[tuple]:
        at = {r[1]: i for i, r in enumerate(rows)}
        sums = settle([at.get(r[2], -1) for r in rows], [r[3] for r in rows], [r[4:4 + len(values)] for r in rows])
        for r, s in zip(rows, sums):
            yield r[1], *[a + b for a, b in zip(s, r[4 + len(values):])]

    def run(batches):
        names = ["node", *values]
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[0][0] != row[0]:
                    out += one(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*one(held))], names=names)
    return run


def rollup(nodes: DataFrame, places: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """(node, values): sums of the ``values`` (longs) over every node's subtree, from
    the table of nodes (node, parent, conv_id, depth, weight, values) of one tree and
    the staged table of places (conv_id, pos, node, parent)."""
    spark = nodes.sparkSession
    ship(spark)
    added = [f"added_{v}" for v in values]
    state = stage(spark, nodes.select("node", "parent", "conv_id", "depth", "weight", *values,
                                      *[F.lit(0).cast("long").alias(a) for a in added],
                                      root_name().alias("part")), "trie-state")
    staged, small, settled = [state], [], []
    turn = places.select(F.col("conv_id").alias("c"), F.col("pos").alias("p"), F.col("node").alias("child"),
                         F.col("parent").alias("above"))
    while True:
        totals = state.groupBy("part").agg(F.max("weight").alias("total"))
        sized = state.join(totals, "part")
        small.append(sized.where(F.col("total") <= local))
        big = sized.where(F.col("total") > local)
        if big.isEmpty():
            break
        heavy = F.col("weight") * 2 > F.col("total")
        centre = big.where(heavy).groupBy("part").agg(F.max(F.struct("depth", "node", "weight")).alias("z"))
        split = big.join(centre, "part")
        split = split.join(turn, (F.col("conv_id") == F.col("c")) & (F.col("p") == F.col("z.depth") + 1)
                           & (F.col("depth") > F.col("z.depth")), "left")
        split = split.withColumn("side", F.when(F.col("node") == F.col("z.node"), 0).when(
            F.col("above") == F.col("z.node"), 1).otherwise(-1)).withColumn("on_path", heavy)
        split = stage(spark, split.drop("c", "p", "above"), "trie-split")
        below = split.where("side >= 0").groupBy("part").agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
        split_up = split.join(below, "part")
        centres = stage(spark, split_up.where("side = 0").select(
            "node", *[(F.col(a) + F.col(f"sum_{v}")).alias(v) for v, a in zip(values, added)]), "trie-centres")
        path = F.col("on_path") & (F.col("side") == -1)
        state = stage(spark, split_up.where("side <> 0").select(
            "node", "parent", "conv_id", "depth",
            F.when(path, F.col("weight") - F.col("z.weight")).otherwise(F.col("weight")).alias("weight"), *values,
            *[F.when(path, F.col(a) + F.col(f"sum_{v}")).otherwise(F.col(a)).alias(a) for v, a in zip(values, added)],
            F.when(F.col("side") == 1, F.col("child")).otherwise(F.col("part")).alias("part")), "trie-state")
        staged += [split, state]
        settled.append(centres)
    rest = small[0]
    for other in small[1:]:
        rest = rest.unionByName(other)
    rest = rest.select("part", "node", "parent", "weight", *values, *added, "depth")
    rest = rest.repartition("part").sortWithinPartitions("part", "depth").drop("depth")
    out = rest.mapInArrow(_finish(values), "node string, " + ", ".join(f"{v} long" for v in values))
    for table in settled:
        out = out.unionByName(table)
    out = stage(spark, out, "trie-rollup")
    unstage(*staged, *settled)
    return out


def _joined_ids(batches):
    """Rows sorted by (node, conv_id) to texts of at most IDS joined ids."""
    for batch in batches:
        nodes, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows, start = [], 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or nodes[i] != nodes[start] or i - start == IDS:
                rows.append((nodes[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["node", "first", "ids"])


def _hashed(batches):
    """Rows sorted by (node, first id) to one SHA-256 per node, streamed."""
    node, state = None, None
    for batch in batches:
        out = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def ending_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the comma-joined ids of (node, conv_id) rows,
    in ascending order per node."""
    ship(ends.sparkSession)
    texts = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _joined_ids, "node string, first long, ids string")
    return texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(
        _hashed, "node string, ends_sha256 string")


def prefix_trie(rows: DataFrame, convs: DataFrame, local: int = LOCAL) -> DataFrame:
    """The trie of conversations: ``rows`` (conv_id, pos, length, digest, n_bytes)
    holds their turns, ``convs`` (conv_id, length) all of them, also those without
    turns.  One row per node."""
    spark = rows.sparkSession
    places = stage(spark, places_of(rows), "trie-places")
    convs = stage(spark, convs, "trie-conversations")
    nodes = stage(spark, nodes_of(places, convs).withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}), "trie-nodes")
    sums = rollup(nodes, places, ["n_leaves", "saved_tokens"], local)
    ends = places.where("pos = length").select("node", "conv_id").unionByName(
        convs.where("length = 0").select(root_name().alias("node"), "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, "node").join(ending_digests(ends), "node", "left").join(
        parents, "parent", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = stage(spark, out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                  F.coalesce("ends_sha256", nothing).alias("ends_sha256")), "trie-result")
    unstage(places, convs, nodes, sums)
    return out


def conversation_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """The trie of the rebuilt conversations (see ``shared_beginnings``) of a table
    (conv_id, turn, role, text)."""
    turns, read = numbered(conversations)
    turns = stage(conversations.sparkSession, turns, "trie-numbered")
    unstage(*read)
    out = prefix_trie(*shared_beginnings(turns), local)
    unstage(turns)
    return out
