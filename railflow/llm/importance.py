"""Operator 11, target-distribution importance resampling by bit-sliced aggregation.

A text's features are its runs of one to three words, each hashed to one of
``BUCKETS`` buckets.  Bucket counts of all documents and of all target texts give
every bucket a whole gain (the log ratio of smoothed shares).  A document's weight,
the sum of the gains of its features, is computed **bit-sliced**: the bits of its
bucket counts are planes of ``BUCKETS`` bits, the gains are planes in two's complement;
a pair of planes contributes its common bits (AND, popcount) times a power of two, and
minus that where the gain's plane is the sign.  All sums are whole numbers, so weights
are exact and do not depend on any order.

The weight plus Gumbel noise of the document's id is its score; the highest scores of
the documents with enough words are drawn: a sample without replacement with chances in
proportion to exp(weight).

Both passes over the texts are narrow: each task adds up its bucket counts before the
only shuffle of the counts (at most BUCKETS rows a task), and only (id, score) rows are
sorted.  Texts are read as bytes in parts of at most ``PART`` bytes, cut between words;
the two words before a part are carried over.  Ranks come from a range sort and the
rows per partition, never from one window.

Defined results: a null text has no features; it and blank texts weigh 0; documents
with the same doc_id get the same noise, and equal scores and ids are ranked in any
order; a null id is hashed as the empty text and comes last among equals; an empty
table gives no rows; without target texts all gains still follow the formula; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railflow.llm.common import ship, stage, unstage

BUCKETS = 10_000
LONGEST = 3                 # words in a feature
SEED = 42
PERCENT, LEAST_WORDS = 5, 20
PART = 1 << 20              # bytes of a text that are split into words at once
ROWS = 32                   # documents whose planes are held at once

# All bytes but digits, letters and those of non-ASCII characters separate words; A-Z become a-z.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _parts(text: memoryview | bytes) -> Iterator[bytes]:
    """The text's bytes, small and with spaces only between words, in parts."""
    start, size = 0, len(text)
    while size - start > PART:
        part = bytes(text[start:start + PART]).translate(_KEPT)
        cut = part.rfind(b" ") + 1
        while not cut:      # one word fills the part: take more
            more = bytes(text[start + len(part):start + len(part) + PART]).translate(_KEPT)
            if not more:
                break
            cut = more.find(b" ") + 1 and len(part) + more.find(b" ") + 1
            part += more
        cut = cut or len(part)
        yield part[:cut]
        start += cut
    yield bytes(text[start:]).translate(_KEPT)


def features(text: bytes | memoryview | None) -> Iterator[tuple[int, np.ndarray]]:
    """(words, CRC-32 of every feature) of the text, part by part.  The checksum of a
    run is that of the run without its last word, continued over a space and the word."""
    carried: list[bytes] = []
    for part in _parts(text or b""):
        fresh = part.split()
        if not fresh:
            continue
        words = carried + fresh
        spaced = [b" " + w for w in words]
        sums, out = [zlib.crc32(w) for w in words], []
        for n in range(LONGEST):
            if n:
                sums = list(map(zlib.crc32, spaced[n:], sums))
            out.append(np.array(sums[max(0, len(carried) - n):], np.uint32))   # runs that end in this part
        yield len(fresh), np.concatenate(out)
        carried = words[1 - LONGEST:]


def bucket_counts(text: bytes | memoryview | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(words, features per bucket) of a text."""
    words, counts = 0, np.zeros(buckets, np.int64)
    for n, sums in features(text):
        words += n
        counts += np.bincount(sums % np.uint32(buckets), minlength=buckets)
    return words, counts


def _bytes_of(column: pa.Array) -> Iterator[bytes | memoryview | None]:
    for value in column.cast(pa.large_binary()):
        yield value.as_buffer() if value.is_valid else None


def corpus_counts(df: DataFrame, text_col: str, buckets: int = BUCKETS) -> list[int]:
    """Features per bucket over all rows; a task sends its sums only."""
    ship(df.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _bytes_of(batch.column(0)):
                total += bucket_counts(text, buckets)[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    sums = df.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for bucket, n in sums.collect():     # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Whole gain of every bucket, from both corpora's counts."""
    size, s_all, t_all = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for s, t in zip(source, target)]


def planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of rows of numbers: (rows, bits, words of 64 bits)."""
    rows, width = numbers.shape
    padded = np.zeros((rows, -(-width // 64) * 64), np.uint8)
    out = np.empty((rows, bits, padded.shape[1] // 64), np.uint64)
    for bit in range(bits):
        padded[:, :width] = (numbers >> bit) & 1
        out[:, bit] = np.packbits(padded, axis=1).view(np.uint64)
    return out


class BitSlicedGains:
    """Sums of gains over bucket counts, by AND and popcount of bit planes."""

    def __init__(self, gain: list[int]):
        self.bits = max(abs(g) for g in gain).bit_length() + 1      # two's complement
        self.planes = planes(np.array([gain], np.int64), self.bits)[0]
        self.powers = [1 << b for b in range(self.bits - 1)] + [-(1 << self.bits - 1)]

    def weights(self, counts: np.ndarray) -> list[int]:
        """Exact weight of every row of bucket counts."""
        depth = int(counts.max(initial=0)).bit_length()
        sums = [0] * len(counts)
        for bit, plane in enumerate(planes(counts, depth).swapaxes(0, 1)):
            common = np.bitwise_count(plane[:, None, :] & self.planes[None]).sum(axis=2, dtype=np.int64)
            for row, numbers in enumerate(common.tolist()):
                sums[row] += sum(n * p for n, p in zip(numbers, self.powers)) << bit
        return sums


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, by the id's hash."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """(rid, doc_id, n_words, n_features, weight, score) of every document."""
    ship(docs.sparkSession)
    names = ["rid", "doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches):
        sliced = BitSlicedGains(gain)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                found = [bucket_counts(text, len(gain)) for text in _bytes_of(batch.column(2))]
                counts = np.stack([c for _, c in found])
                weights = sliced.weights(counts)
                scores = [w + noise(i, seed) for w, i in zip(weights, batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.int64()),
                     pa.array(counts.sum(axis=1)), pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """(rid, rank) of the ``drawn`` highest scores (rows: a staged table), by a range
    sort; ties go to the smaller id."""
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid").asc()]
    cut = stage(spark, rows.select("rid", "doc_id", "score").repartitionByRange(*order).sortWithinPartitions(*order).select(
        "rid", F.monotonically_increasing_id().alias("at")), "importance-order")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for number, n in sorted(cut.groupBy(part.alias("part")).count().collect()):    # one row per partition
        starts.append((number, total))
        total += n
    starts = spark.createDataFrame(starts or [(0, 0)], "part long, start long")
    out = cut.withColumn("part", part).join(F.broadcast(starts), "part").select(
        "rid", (F.col("start") + place + 1).alias("rank")).where(F.col("rank") <= drawn)
    out = stage(spark, out, "importance-ranks")
    unstage(cut)
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED,
             least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Weights of all documents towards the texts of ``target``, and the rank of the
    drawn ones: ``percent`` of those with at least ``least_words`` words."""
    gain = gains(corpus_counts(docs, "text", buckets), corpus_counts(target, "text", buckets))
    rows = stage(docs.sparkSession, scored(docs, gain, seed), "importance-scores")
    able = rows.where(F.col("n_words") >= least_words)
    ranks = ranked(able, able.count() * percent // 100)
    out = stage(docs.sparkSession, rows.join(ranks, "rid", "left").drop("rid"), "importance-result")
    unstage(rows, ranks)
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
