"""Operator 2, token counts: Arrow batches in, lengths out.

A byte-level tokenizer's pattern never joins a non-space character to white
space that follows it, so a text may be cut at every such place and the
lengths added up.  Two uses are made of this:

* a text above ``SPLIT_CHARS`` is cut at safe boundaries, so one very long text
  neither dominates a batch nor needs memory in proportion to its length;
* within a part, pieces (white space and the word after it) that were already
  encoded by this worker are looked up in a bounded table.

What is left is encoded in batches balanced by bytes.  Only lengths leave the
worker.  A byte-level vocabulary is given by its rank file, whose library needs a
third of the time; the tests hold its counts against the library of the .json
file, over texts and over every code point below U+20000.

Defined results: null and empty text count 0 tokens and 0 bytes; a very long
text without any safe boundary is encoded whole; repeated rows are counted
each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from railflow.llm.common import ship

SPLIT_CHARS = 1 << 16      # longer texts are cut
BATCH_BYTES = 1 << 20      # bytes encoded in one call of the library
KEPT_PIECES = 800_000      # lengths remembered by a worker
LONGEST_KEPT = 48          # longer pieces are not remembered
LIMIT = 1024

_PIECE = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_CUT = re.compile(r"(?<=\S)(?=[\t-\r ])")
# Unicode white space beyond ASCII (fixed values): next to it a piece is no safe unit.
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def safe_parts(text: str, split_chars: int = SPLIT_CHARS) -> list[str]:
    """Parts of about ``split_chars`` that encode to the same tokens as the whole."""
    parts, start = [], 0
    while len(text) - start > split_chars:
        cut = _CUT.search(text, start + split_chars)
        if cut is None:
            break
        parts.append(text[start:cut.start()])
        start = cut.start()
    parts.append(text[start:])
    return parts


def balanced(texts: list[str | None], split_chars: int, batch_bytes: int) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of (row numbers, parts) of about ``batch_bytes`` each."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        for part in (safe_parts(text, split_chars) if len(text) > split_chars else (text,)):
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= batch_bytes:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


class PieceLengths:
    """Token counts of parts, remembering the lengths of recurring pieces."""

    def __init__(self, encode_lengths: Callable[[list[str]], list[int]], keep: int = KEPT_PIECES):
        self.encode_lengths, self.keep, self.known = encode_lengths, keep, {}

    def counts(self, parts: list[str]) -> list[int]:
        known, cut, new, whole = self.known, [], set(), []
        for n, part in enumerate(parts):
            if _OTHER_SPACE.search(part):
                whole.append(n)
                cut.append(())
                continue
            pieces = _PIECE.findall(part)
            cut.append(pieces)
            new.update(pieces)
        new = [p for p in new if p not in known]
        found = dict(zip(new, self.encode_lengths(new)))
        out = []
        for pieces in cut:
            try:
                out.append(sum(map(known.__getitem__, pieces)))
            except KeyError:
                out.append(sum(known[p] if p in known else found[p] for p in pieces))
        for n, length in zip(whole, self.encode_lengths([parts[n] for n in whole])):
            out[n] = length
        if len(known) + len(found) > self.keep:
            known.clear()
        known.update((p, c) for p, c in found.items() if len(p) <= LONGEST_KEPT)
        return out


# Special tokens of the rank files (fixed values).
SPECIAL = {"byte_bpe_50k.tiktoken": {"<|endoftext|>": 50256}, "byte_bpe_multi_50k.tiktoken": {}}

_loaded: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(name: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole parts by the named public tokenizer, built once per worker."""
    if name not in _loaded:
        import public_tokenizers
        path = public_tokenizers.path(name)
        if name.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[name] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            import tiktoken
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            model = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=SPECIAL[name])
            _loaded[name] = PieceLengths(
                lambda texts: [len(model.encode(x, allowed_special="all")) if "<|" in x
                               else len(model.encode_ordinary(x)) for x in texts]).counts
    return _loaded[name]


def count_tokens(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "byte_bpe_50k.tiktoken",
                 limit: int = LIMIT, split_chars: int = SPLIT_CHARS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``tokenizer`` names a byte-level BPE (.tiktoken, the vocabulary of the .json
    file of that name), whose texts may be cut, or a sentencepiece model
    (.model), which gets whole texts.
    """
    ship(df.sparkSession)
    split = split_chars if tokenizer.endswith(".tiktoken") else 1 << 62

    def lengths(batches):
        count = counter(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [0] * len(texts)
            for rows, parts in balanced(texts, split, batch_bytes):
                for row, n in zip(rows, count(parts)):
                    counts[row] += n
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        lengths, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
