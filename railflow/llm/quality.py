"""Operator 3, quality rules: boosted trees over document statistics.

Statistics of a text (words, symbols, repeated lines, repeated 5-word windows
and rates of them) are computed in Arrow batches over whole texts.  A
gradient-boosted tree classifier is trained on labelled documents: those with
the ``SAMPLE_ROWS`` smallest hashes of their id, a documented bound that fits the
driver.  Chosen features are monotonic: more symbols, repeats or shouting never
raise the score.  The fitted trees are flattened into numpy node arrays, and a
batch walks down all trees at once.

Defined results: a null or empty text has no words, all counts 0, and fails the
base rules; a very long text is measured whole; repeated rows are judged each; an
empty table gives no rows; null labels and ids are ignored in training, an id
labelled twice counts as bad if any label says so; without labelled rows of both
kinds the verdict is that of the base rules; ``keep_good`` keeps extra columns,
the query ignores them.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railflow.llm.common import fresh, hash60, ship

SAMPLE_ROWS = 8000        # labelled documents used in training, at most
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
THRESHOLD = 0.5           # a document is kept if its score is at least this

# Feature -> sign of its effect on the score (0: free).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1,
    "shout_rate": -1, "mark_rate": -1, "stop_rate": 0, "distinct_rate": 0, "line_words": 0, "digit_rate": 0,
}
# Frequent short words of four languages (fixed values).
STOP_WORDS = frozenset(w.encode() for w in (
    "the of and to in is it that for on with as be at by this are was from or an "
    "der die und das von zu ist mit den ein für im nicht sich auf "
    "de la le et les des en un une est que pour dans qui par sur "
    "el los las y del se por con para su al lo como").split())

STATS = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long," \
        "base_failed:boolean,kept:boolean,score:double>"


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside any 5-word window that occurs twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    span = int(ids.max()) + 1
    # exact numbers of 2-, 4- and 5-word windows
    two = np.unique(ids[:-1] * span + ids[1:], return_inverse=True)[1]
    four = np.unique(two[:-2] * (int(two.max()) + 1) + two[2:], return_inverse=True)[1]
    _, number, counts = np.unique(four[:n] * span + ids[window - 1:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[number] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the
    features of one text."""
    text = text or ""
    data = text.encode()
    words = data.split()                       # bytes split at exactly space and U+0009..U+000D
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    dup_lines = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    repeats = repeated_words(ids)
    shouted = sum(map(eq, words, text.upper().encode().split()))
    stops = sum(map(STOP_WORDS.__contains__, data.lower().translate(None, b".,;:!?").split()))
    marks = sum(map(data.count, (b"!", b"?", b";", b"=", b"{", b"}")))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    per_word, per_char, per_line = 1 / max(n, 1), 1 / max(chars, 1), 1 / max(len(lines), 1)
    return ((n, chars, symbols, dup_lines, repeats),
            [float(np.log1p(n)), chars * per_word, symbols * per_char, dup_lines * per_line, repeats * per_word,
             shouted * per_word, marks * per_char, stops * per_word, len(seen) * per_word, n * per_line,
             digits * per_char])


def base_failed(base: tuple[int, ...]) -> bool:
    return base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]


@dataclass
class Trees:
    """Boosted trees as node arrays (tree, node); a leaf points to itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of a good document per row."""
        trees = np.arange(self.feature.shape[0])
        at = np.zeros((len(rows), len(trees)), np.int64)
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            low = rows[row, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(low, self.left[trees, at], self.right[trees, at])
        return 1 / (1 + np.exp(-(self.start + self.value[trees, at].sum(axis=1))))


def fit(rows: np.ndarray, good: np.ndarray, signs: list[int], n_trees: int = 60, depth: int = 3,
        rate: float = 0.2, n_bins: int = 48, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Boost regression trees on the logistic loss.  A split of a feature with a
    sign must order its children's values by that sign, and the middle of the two
    bounds all values below, so the sum of the trees is monotonic too."""
    n, width = rows.shape
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
    share = min(max(good.mean(), 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    nodes = 2 ** (depth + 1) - 1
    shape = (n_trees, nodes)
    feature, threshold = np.zeros(shape, np.int64), np.full(shape, np.inf)
    left = np.tile(np.arange(nodes), (n_trees, 1))
    right, value = left.copy(), np.zeros(shape)
    margin = np.full(n, start)

    def weight(g: float, h: float, low: float, high: float) -> float:
        return min(max(-g / (h + ridge), low), high)

    def gain(g, h, w):
        return -(g * w + 0.5 * (h + ridge) * w * w)

    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - good, np.maximum(p * (1 - p), 1e-9)
        todo, used = [(0, np.arange(n), -np.inf, np.inf, 0)], 1
        while todo:
            node, own, low, high, level = todo.pop()
            g, h = grad[own].sum(), hess[own].sum()
            w = weight(g, h, low, high)
            value[t, node] = rate * w
            best = (1e-6, None)
            for f in range(width) if level < depth else ():
                if not len(cuts[f]):
                    continue
                gs = np.cumsum(np.bincount(bins[own, f], grad[own], len(cuts[f]) + 1))[:-1]
                hs = np.cumsum(np.bincount(bins[own, f], hess[own], len(cuts[f]) + 1))[:-1]
                wl = np.clip(-gs / (hs + ridge), low, high)
                wr = np.clip(-(g - gs) / (h - hs + ridge), low, high)
                gains = gain(gs, hs, wl) + gain(g - gs, h - hs, wr) - gain(g, h, w)
                gains[(hs < least) | (h - hs < least) | (signs[f] * (wr - wl) < 0)] = -1
                k = int(np.argmax(gains))
                if gains[k] > best[0]:
                    best = (float(gains[k]), (f, k, wl[k], wr[k]))
            if best[1] is None:
                margin[own] += value[t, node]
                continue
            f, k, wl, wr = best[1]
            feature[t, node], threshold[t, node] = f, cuts[f][k]
            left[t, node], right[t, node] = used, used + 1
            below, middle = bins[own, f] <= k, (wl + wr) / 2
            spans = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)),
                     -1: ((middle, high), (low, middle))}[signs[f]]
            todo.append((used, own[below], *spans[0], level + 1))
            todo.append((used + 1, own[~below], *spans[1], level + 1))
            used += 2
    return Trees(feature, threshold, left, right, value, start, depth)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Fit on a bounded sample of labelled documents; None without two kinds."""
    ship(docs.sparkSession)
    sample = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("_good"))
    sample = sample.orderBy(hash60(F.lit("quality"), F.col("doc_id")), "doc_id").limit(sample_rows)
    # the sample is bounded by sample_rows, so it may be broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "_good").agg(
        F.min("text").alias("text"))

    @F.arrow_udf("array<double>")
    def features(text: pa.Array) -> pa.Array:
        return pa.array([measure(t)[1] for t in text.to_pylist()], pa.list_(pa.float64()))

    found = sorted((r.doc_id, int(r._good > 0), r.x) for r in
                   texts.select("doc_id", "_good", features("text").alias("x")).toLocalIterator())
    good = np.array([r[1] for r in found], float)
    if not len(good) or good.min() == good.max():
        return None
    return fit(np.array([r[2] for r in found]), good, list(FEATURES.values()))


def judged(text: Column, trees: Trees | None, threshold: float = THRESHOLD) -> Column:
    """Struct of the statistics and the verdict on a text column."""

    @F.arrow_udf(STATS)
    def stats(texts: pa.Array) -> pa.Array:
        measured = [measure(t) for t in texts.to_pylist()]
        failed = [base_failed(b) for b, _ in measured]
        score = [None] * len(measured)
        if trees is not None and measured:
            score = trees.score(np.array([x for _, x in measured])).tolist()
        kept = [not bad and (s is None or s >= threshold) for bad, s in zip(failed, score)]
        columns = [pa.array([b[i] for b, _ in measured], pa.int64()) for i in range(5)]
        columns += [pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(score, pa.float64())]
        return pa.StructArray.from_arrays(columns, [
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])

    return stats(text)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document."""
    trees = train(docs, labels)
    return docs.select("doc_id", judged(F.col("text"), trees).alias("q")).select(
        "doc_id", *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept", "score")])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    trees = train(docs, labels)
    verdict = fresh(docs, "quality_verdict")
    return docs.withColumn(verdict, judged(F.col("text"), trees)).where(F.col(verdict)["kept"]).drop(verdict)
