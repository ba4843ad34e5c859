"""Operator 10, MinHash near-dedup: HyperMinHash registers, bands, exact checks.

A document's set are its distinct k-word shingles (64-bit hashes).  Each of 128
registers keeps, of the smallest of an own permutation's values, only the number
of leading zeros (6 bits) and the ten bits behind the leading one: 16 bits instead
of 64.  Four registers fill one long, so the 32 longs of a sketch are also its
32 band keys.

1. Equal sets collapse to one node (by a 128-bit digest); nodes are numbered by
   their smallest doc_id.
2. Nodes that share a band key are candidates.  A bucket may hold a third of all
   rows, so it is not expanded into pairs: each member is paired with its
   bucket's smallest node, then, where a bucket still spans several components,
   with its largest.
3. What then remains of a bucket outside its largest component is compared with
   the bucket's other components, in blocks of bounded size: every candidate
   pair that could still change a component is looked at, so no link is lost to
   the stars.  There the sets are kept as differences from a common home set, so
   the worker checks a pair exactly and only links leave it.
4. Candidates pass a collision-corrected estimate of the Jaccard index, five
   standard errors below the threshold, then an exact check on the full sets.
5. Components grow by smallest label with pointer jumping.

At a similarity of 0.85 a linked pair shares no band with probability
(1 - 0.85^4)^32 < 1e-10, at 0.8 < 1e-7.

Defined results: a document without words has an empty set, is linked with
nothing and is its own component; one with fewer words than a shingle has one
shingle, the whole sequence; equal sets are linked; repeated rows share their
component; a null doc_id takes part, and its component is the smallest id reached,
if any; an empty table gives no rows; extra columns are ignored (kept by
``keep_one``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railflow.llm.common import fresh, ship, stage, unstage

BANDS = 32                 # longs of a sketch
LANES = 4                  # registers of 16 bits in a long
REGISTERS = BANDS * LANES
MANTISSA_BITS = 10
SKETCH = [f"b{j}" for j in range(BANDS)]
CHUNK = 1 << 15            # shingles permuted at a time
KEPT_WORDS = 100_000       # word hashes remembered by a worker, also after the stage while it is kept
BLOCK = 4096               # members of a bucket compared at a time
DEVIATIONS = 5             # of the estimate below the threshold


def _odd_constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2 ** 64, n, np.uint64) | np.uint64(1)


_POSITION = _odd_constants(64, 11)
_FACTOR, _SHIFT = _odd_constants(REGISTERS, 12), _odd_constants(REGISTERS, 13)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (A-Z lower-cased)."""
    words = text.encode().lower().split() if text else []   # bytes: only A-Z, only ASCII white space
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if len(_words) > KEPT_WORDS:
        _words.clear()
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    width = min(k, n)
    count = n - width + 1
    total = np.full(count, width, np.uint64)
    for i in range(width):
        total += _mix(ids[i:i + count] + _POSITION[i % 64]) * _POSITION[(i + 7) % 64]
    return np.unique(_mix(total))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), BANDS) longs of the non-empty sets."""
    out = np.empty((len(sets), REGISTERS), np.uint16)
    for low, high in _chunks(sets):
        values = np.concatenate(sets[low:high])
        starts = np.cumsum([0, *map(len, sets[low:high - 1])])
        for r in range(REGISTERS):
            least = np.minimum.reduceat(values * _FACTOR[r] + _SHIFT[r], starts)
            bits = least.astype(np.float64).view(np.uint64)
            zeros = np.uint64(63 + 1023) - (bits >> np.uint64(52))          # float's exponent
            mantissa = (bits >> np.uint64(52 - MANTISSA_BITS)) & np.uint64(2 ** MANTISSA_BITS - 1)
            out[low:high, r] = (np.minimum(zeros, np.uint64(63)) << np.uint64(MANTISSA_BITS)) | mantissa
    return out.view(np.int64)


def _chunks(sets: list[np.ndarray]):
    low = size = 0
    for i, s in enumerate(sets):
        size += len(s)
        if size >= CHUNK:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(sets):
        yield low, len(sets)


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sketched(text: Column, k: int) -> Column:
    @F.arrow_udf("struct<n:long, digest:binary, bands:array<long>>")
    def run(texts: pa.Array) -> pa.Array:
        sets = [shingles(t, k) for t in texts.to_pylist()]
        full = [s for s in sets if len(s)]
        rows = iter(sketches(full).tolist() if full else [])
        return pa.StructArray.from_arrays(
            [pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()),
             pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64()))],
            ["n", "digest", "bands"])
    return run(text)


def _set_of(text: Column, k: int) -> Column:
    @F.arrow_udf("struct<digest:binary, members:array<long>>")
    def run(texts: pa.Array) -> pa.Array:
        sets = [shingles(t, k) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([_digest(s) for s in sets], pa.binary()),
             pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["digest", "members"])
    return run(text)


def _slack(percent: int) -> float:
    t = percent / 100
    return t - DEVIATIONS * (t * (1 - t) / REGISTERS) ** 0.5


def estimate(n: np.ndarray, m: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the number of equal registers, without those that
    agree by chance: two independent minima of n and m values share a bin of
    relative width 2^-MANTISSA_BITS with probability
    0.7213 * 2^-MANTISSA_BITS * nm / (n + m)^2."""
    n, m = np.asarray(n, float), np.asarray(m, float)
    chance = 0.7213 / 2 ** MANTISSA_BITS * n * m / ((n + m) * (n + m))
    return (same / REGISTERS - chance) / (1 - chance)


def _possible(percent: int) -> Column:
    """Whether the sketches of a pair (l, r) allow a link."""
    least = _slack(percent)

    @F.arrow_udf("boolean")
    def run(n: pa.Array, left: pa.Array, m: pa.Array, right: pa.Array) -> pa.Array:
        n, m = n.to_numpy(zero_copy_only=False), m.to_numpy(zero_copy_only=False)
        same = (_registers(left) == _registers(right)).sum(axis=1)
        sizes = np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
        return pa.array(sizes & (estimate(n, m, same) >= least))
    return run("l.n", "l.bands", "r.n", "r.bands")


def _registers(bands: pa.Array) -> np.ndarray:
    return bands.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(-1, REGISTERS)


def _block_pairs(group: pa.Table, percent: int) -> tuple[list[int], list[int], list[bool]]:
    """Pairs (a, b, sure) of different labels in one group of blocks, one member
    at least outside the bucket's largest component.  Pairs with the same home
    are checked here on their full sets: with added A and removed R against the
    home set H, the intersection of x and y has |H| - |Rx or Ry| + |Ax and Ay|
    members.  Others that the estimate allows are given back unsure."""
    node, label, top, block, n, home, home_n = (
        group.column(c).to_numpy() for c in ("node", "label", "top", "block", "n", "home", "home_n"))
    bands = group.column("bands").combine_chunks()
    registers, longs = _registers(bands), _registers(bands).view(np.int64)
    added, removed = group.column("added").combine_chunks(), group.column("removed").combine_chunks()
    sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def diffs(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in sets:
            sets[i] = tuple(c[i].values.to_numpy(zero_copy_only=False) for c in (added, removed))
        return sets[i]

    band, least = group.column("band")[0].as_py(), _slack(percent)
    several = len(np.unique(block)) > 1
    first, second, sure = [], [], []
    for i in np.flatnonzero(label != top):
        ok = (label != label[i]) & ((label == top) | (node > node[i]))
        ok &= np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent
        if several:            # pairs inside a block are found in that block's own group
            ok &= block != block[i]
        at = np.flatnonzero(ok)
        if len(at):            # a pair belongs to the first band that it shares
            at = at[~(longs[at, :band] == longs[i, :band]).any(axis=1)]
            same = (registers[at] == registers[i]).sum(axis=1)
            at = at[estimate(n[at], n[i], same) >= least]
        for j in at:
            if home[i] == home[j]:
                (ai, ri), (aj, rj) = diffs(i), diffs(j)
                common = home_n[i] - len(ri) - len(rj) + len(np.intersect1d(ri, rj, True)) + len(
                    np.intersect1d(ai, aj, True))
                if 100 * common < percent * (n[i] + n[j] - common):
                    continue
            first.append(int(min(node[i], node[j])))
            second.append(int(max(node[i], node[j])))
            sure.append(bool(home[i] == home[j]))
    return first, second, sure


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, label): the smallest node reachable over edges (a, b)."""
    spark = edges.sparkSession
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(spark, both, f"{label}-edges")
    labels = stage(spark, both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"),
                   f"{label}-labels")
    previous = labels
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = step.select(F.col("node").alias("up_node"), F.col("label").alias("up"))
        step = stage(spark, step.join(up, step.label == up.up_node).select(
            "node", "old", F.least("label", "up").alias("label")), f"{label}-labels")
        changed = step.where("label < old").limit(1).count()
        unstage(previous)
        previous, labels = step, step.select("node", "label")
        if not changed:
            unstage(both)
            return labels


def _pair_batch(slices: list[pa.RecordBatch], percent: int) -> pa.RecordBatch:
    a, b, sure = _block_pairs(pa.Table.from_batches(slices), percent)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure, pa.bool_())],
                                      names=["a", "b", "sure"])


class NearDuplicates:
    """The staged tables of one run: sketches, nodes and component labels."""

    def __init__(self, docs: DataFrame, k: int, percent: int):
        self.docs, self.k, self.percent, self.spark = docs, k, percent, docs.sparkSession
        ship(self.spark)
        sketched = docs.select("doc_id", _sketched(F.col("text"), k).alias("s")).select(
            "doc_id", "s.n", "s.digest", *[F.col("s.bands")[j].alias(b) for j, b in enumerate(SKETCH)])
        self.rows = stage(self.spark, sketched, "neardup-rows")
        nodes = self.rows.where("n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), *[F.first(b).alias(b) for b in SKETCH])
        nodes = nodes.sort(F.col("rep").asc_nulls_last(), "digest").select(
            F.monotonically_increasing_id().alias("node"), "digest", "rep", "n", F.array(*SKETCH).alias("bands"))
        self.nodes = stage(self.spark, nodes, "neardup-nodes")
        self.labels = self._link()

    def _link(self) -> DataFrame:
        """(node, label) of the nodes that have a link."""
        spark = self.spark
        keys = self.nodes.select("node", F.posexplode("bands").alias("band", "value")).select(
            "node", "band", F.xxhash64("band", "value").alias("key"))
        shared = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("first"),
                                         F.max("node").alias("last")).where("size > 1")
        members = stage(spark, keys.join(shared, "key").select("key", "band", "node", "first", "last"), "neardup-members")
        self.sets = self._sets(members.select("node").distinct())
        checked = self._verified(members.where("node != first").select(
            F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "star")
        labels = components(checked, "neardup-star")
        mixed = self._mixed(members, labels)
        ends = mixed.where("node != last").select("last", "last_label", "node", "label").where(
            "last_label != label").select(F.least("node", "last").alias("a"), F.greatest("node", "last").alias("b"))
        more = self._verified(ends.distinct(), "last")
        links = stage(spark, checked.unionByName(more), "neardup-links")
        labels = components(links, "neardup-last")
        mixed = stage(spark, self._mixed(members, labels).select("key", "band", "node", "label"), "neardup-mixed")
        pairs = stage(spark, self._cross(mixed, self._homes(members, mixed)), "neardup-pairs")
        rest = self._verified(pairs.where("NOT sure").select("a", "b").distinct(), "cross", estimated=True)
        labels = components(links.unionByName(pairs.where("sure").select("a", "b")).unionByName(rest), "neardup-all")
        unstage(members, self.sets, checked, more, links, rest, mixed, pairs)
        return labels

    def _sets(self, wanted: DataFrame) -> DataFrame:
        """Full shingle sets of the nodes in ``wanted``, from their texts."""
        reps = self.nodes.join(wanted, "node").select("node", F.col("digest").alias("node_digest"), "rep")
        ids = reps.select("rep").distinct()
        texts = self.docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
        found = texts.select(_set_of(F.col("text"), self.k).alias("s")).select("s.*").where("digest IS NOT NULL")
        found = reps.join(found, reps.node_digest == found.digest).select("node", "members")
        return stage(self.spark, found.dropDuplicates(["node"]), "neardup-sets")

    def _verified(self, pairs: DataFrame, label: str, estimated: bool = False) -> DataFrame:
        """Pairs (a, b) whose full sets reach the threshold."""
        if not estimated:
            left, right = self.nodes.alias("l"), self.nodes.alias("r")
            pairs = pairs.join(left, F.col("a") == F.col("l.node")).join(right, F.col("b") == F.col("r.node")).where(
                _possible(self.percent)).select("a", "b")
        one, two = self.sets.alias("s1"), self.sets.alias("s2")
        both = pairs.join(one, F.col("b") == F.col("s1.node")).join(two, F.col("a") == F.col("s2.node"))
        common = F.size(F.array_intersect("s1.members", "s2.members"))
        union = F.size("s1.members") + F.size("s2.members") - common
        return stage(self.spark, both.where(common * 100 >= union * self.percent).select("a", "b"),
                     f"neardup-{label}-links")

    def _mixed(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members with labels, of the buckets that span several components."""
        labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        spans = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                            F.max(F.when(F.col("node") == F.col("last"), F.col("label"))).alias(
                                                "last_label")).where("low < high")
        return labelled.join(spans.select("key", "last_label"), "key")

    def _homes(self, members: DataFrame, mixed: DataFrame) -> DataFrame:
        """Per node of a mixed bucket its set as a difference from a home set:
        the smallest node that its buckets, or that node's buckets, hold.  In a
        large group of near copies nearly all share one home, and the
        differences are a fraction of the sets."""
        first = stage(self.spark, members.groupBy("node").agg(F.min("first").alias("home")), "neardup-homes")
        again = first.select(F.col("node").alias("_home"), F.col("home").alias("_next"))
        homes = first.join(mixed.select("node").distinct(), "node", "left_semi").join(
            again, F.col("home") == F.col("_home")).select("node", F.col("_next").alias("home"))
        base = self.sets.select(F.col("node").alias("_base"), F.col("members").alias("_members"))
        out = homes.join(self.sets, "node").join(base, F.col("home") == F.col("_base")).select(
            "node", "home", F.size("_members").cast("long").alias("home_n"),
            F.array_except("members", "_members").alias("added"), F.array_except("_members", "members").alias("removed"))
        out = stage(self.spark, out, "neardup-differences")
        unstage(first)
        return out

    def _cross(self, mixed: DataFrame, homes: DataFrame) -> DataFrame:
        """Pairs between components that share a bucket: members outside a
        bucket's largest component against all other components."""
        sizes = mixed.groupBy("key", "label").agg(F.count("*").alias("size"))
        top = sizes.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("top"),
                                       F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"))
        # a bucket of several blocks is compared block by block: each row meets every block
        rows = mixed.join(top, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.join(self.nodes.select("node", "n", "bands").join(homes, "node"), "node").select(
            "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "band", "node", "label", "top", "block", "n", "bands", "home", "home_n", "added", "removed")
        percent, by = self.percent, ["key", "low", "high"]

        def pairs(batches):
            held, held_key = [], None
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in by], axis=1)
                cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
                for low, high in zip(cuts, cuts[1:]):
                    if low == high:
                        continue
                    key = tuple(keys[low])
                    if held and key != held_key:
                        yield _pair_batch(held, percent)
                        held = []
                    held.append(batch.slice(low, high - low))
                    held_key = key
            if held:
                yield _pair_batch(held, percent)

        return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(pairs, "a long, b long, sure boolean")

    def result(self) -> DataFrame:
        """Per document: doc_id, n_shingles, component_id, kept, and whether
        this row's set is the one that stays (``stays``)."""
        node = self.nodes.select(F.col("digest").alias("node_digest"), "node").join(self.labels, "node", "left").withColumn(
            "label", F.coalesce("label", "node"))
        reps = self.nodes.select(F.col("node").alias("label"), F.col("rep").alias("component"))
        node = node.join(reps, "label")
        rows = self.rows.select("doc_id", "n", "digest").join(node, F.col("digest") == F.col("node_digest"), "left")
        component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
        return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                           F.col("doc_id").eqNullSafe(component).alias("kept"), "digest",
                           (F.col("doc_id").eqNullSafe(component) & (
                               F.col("node").eqNullSafe(F.col("label")))).alias("stays"))


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    return NearDuplicates(docs, k, percent).result().select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all columns; documents without words
    are kept.  Rows that share an id are told apart by their sets; of rows equal
    in both, the smallest stays."""
    ship(docs.sparkSession)
    run = NearDuplicates(docs, k, percent)
    found = stage(docs.sparkSession, run.result(), "neardup-result")
    unstage(run.rows, run.nodes)
    ids = found.groupBy("doc_id").agg(F.count("*").alias("copies"), F.max("stays").alias("stays"))
    single = ids.where("copies = 1 AND stays AND doc_id IS NOT NULL").select("doc_id")
    out = docs.join(single, "doc_id", "left_semi")
    repeated = ids.where("(copies > 1 OR doc_id IS NULL) AND stays").select("doc_id")
    if repeated.isEmpty():
        return out
    key, own = fresh(docs, "set_digest"), [F.col(c) for c in docs.columns]
    again = docs.join(repeated.withColumnRenamed("doc_id", "_again"), F.col("doc_id").eqNullSafe(F.col("_again")),
                      "left_semi").withColumn(key, _sketched(F.col("text"), k)["digest"])
    stays = found.where("stays").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    again = again.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col(key).eqNullSafe(F.col("_digest")), "left_semi")
    one = again.groupBy("doc_id", key).agg(F.min(F.struct(*own)).alias("row")).select("row.*")
    return out.unionByName(one)


