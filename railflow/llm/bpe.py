"""Operator 5, BPE encoding and decoding: a bounded-lookahead transducer.

Encoding.  The merges of a learned list run in rank order: no rule can apply
before the rules that make its operands.  Compare the runs over a prefix and
over the whole word.  They differ only to the right of a frontier, which starts
at the end of the prefix.  Rule (x, y) moves the frontier left over x only when a
y starts exactly at the frontier, and then the token at the new frontier starts
with x.  So the moves form a chain of rules of growing rank in which the x of one
rule lies on the left spine (the token, its left part, the left part of that, ...)
of the next rule's y.  The longest such chain, found by one pass over the list,
bounds how far the end of a prefix can be felt: the **sufficient lookahead**.
Tokens that end before (end of buffer - lookahead) are stable and are emitted;
encoding goes on behind them, in a buffer of constant size.

Decoding.  A state machine takes token ids one at a time and gives text at once:
either the tokens' own spelling joined by one space (what the library does for a
file without a decoder), or the text behind the byte alphabet, where an unfinished
UTF-8 sequence is held back until its last byte.

Defined results: null and empty text give no tokens and the empty text; a very
long word is streamed; special strings inside a text become their special ids;
repeated rows are encoded each; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import json
import operator
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from railflow.llm.common import ship

TOKENIZER = "word_bpe_49k.json"
KEPT = 150_000         # spellings in a table of a worker before the older half is forgotten; two tables of two halves
ROWS_OUT = 512         # rows in a batch of results
STREAM_STEP = 4096     # symbols taken into the buffer at a time

# Pattern of the vocabulary's words (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Unicode details in which the vocabulary's library differs from Python's modules (fixed values):
# code points that are neither letters nor digits to it ...
NOT_IN_WORDS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
# ... and capitals (first, last) with the small letter of the first.
MORE_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
    (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]
_PIECE = re.compile(r"[^\t-\r ]+")   # ASCII white space never lies inside a token
regex_match = operator.methodcaller("group")


def byte_alphabet() -> dict[int, str]:
    """Printable stand-in of every byte: itself where printable, else the next
    free character from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {}, 0x100
    for b in range(256):
        if b in shown:
            table[b] = chr(b)
        else:
            table[b] = chr(extra)
            extra += 1
    return table


class MergeList:
    """Vocabulary and merges as numbers, with the sufficient lookahead."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.rank_of: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []     # by rank
        parts: dict[int, tuple[int, int]] = {}
        lengths = {}
        for text, number in vocab.items():
            lengths[number] = max(1, len(text) - len(suffix) if suffix and text.endswith(suffix) else len(text))
        felt: dict[int, int] = {}      # token x -> longest chain that ends in a rule (x, ...)
        self.lookahead = 0
        for a, b in merges:
            x, y, merged = vocab[a], vocab[b], vocab[a + b]
            if (x, y) in self.rank_of:
                continue
            self.rank_of[x, y] = len(self.merged)
            self.merged.append(merged)
            parts.setdefault(merged, (x, y))
            chain, spine = 0, y
            while True:
                chain = max(chain, felt.get(spine, 0))
                if spine not in parts:
                    break
                spine = parts[spine][0]
            chain += lengths[x]
            felt[x] = max(felt.get(x, 0), chain)
            self.lookahead = max(self.lookahead, chain)
        done = set(vocab.values()) - set(self.merged)
        for (x, y), rank in self.rank_of.items():
            if x not in done or y not in done:
                raise ValueError("a merge uses a token that only a later merge makes")
            done.add(self.merged[rank])

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges, lowest rank first, leftmost first among equals."""
        if len(symbols) > 64:
            return self._merge_long(symbols)
        rank_of, none, out = self.rank_of, len(self.merged), symbols[:]
        ranks = [rank_of.get(pair, none) for pair in zip(out, out[1:])]
        while ranks:
            rank = min(ranks)
            if rank == none:
                break
            i = ranks.index(rank)
            out[i:i + 2] = (self.merged[rank],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of.get((out[i - 1], out[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of.get((out[i], out[i + 1]), none)
        return out

    def _merge_long(self, symbols: list[int]) -> list[int]:
        rank_of, n = self.rank_of, len(symbols)
        token, after, before = symbols[:], [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = []
        for i in range(n - 1):
            rank = rank_of.get((token[i], token[i + 1]))
            if rank is not None:
                heap.append((rank, i, token[i], token[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = after[i]
            if token[i] != x or j >= n or token[j] != y:
                continue     # overtaken by another merge
            token[i], token[j], after[i] = self.merged[rank], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    rank = rank_of.get((token[left], token[right]))
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, token[left], token[right]))
        return [t for t in token if t >= 0]


class Transducer:
    """Streams the symbols of one word into stable tokens, in constant memory."""

    def __init__(self, merges: MergeList, token_lengths: dict[int, int], step: int = STREAM_STEP):
        self.merges, self.lengths, self.step = merges, token_lengths, step

    def tokens(self, symbols: Iterable[int]) -> Iterator[int]:
        """``symbols``: base token ids, the last one in its word-end form."""
        size = self.merges.lookahead + self.step
        if isinstance(symbols, list) and len(symbols) < size:     # all in the buffer: nothing to wait for
            yield from self.merges.merge(symbols)
            return
        symbols = iter(symbols)
        buffer = [*itertools.islice(symbols, size)]
        more = len(buffer) == size
        while more:
            stable, kept = len(buffer) - self.merges.lookahead, 0
            for token in self.merges.merge(buffer):
                if kept + self.lengths[token] > stable:
                    break
                kept += self.lengths[token]
                yield token
            fresh = [*itertools.islice(symbols, kept or self.step)]
            buffer, more = buffer[kept:] + fresh, bool(fresh)
        yield from self.merges.merge(buffer)


class WordTokenizer:
    """Encoder and decoder of a word-end BPE file with a byte alphabet."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"] or ""
        self.merges = MergeList(model["vocab"], merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelling = {v: k for k, v in model["vocab"].items()} | {v: k for k, v in self.special.items()}
        lengths = {v: len(k) - (len(self.suffix) if k.endswith(self.suffix) and k != self.suffix else 0)
                   for k, v in model["vocab"].items()}
        self.transducer = Transducer(self.merges, lengths)
        alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in alphabet.items()}
        self.inner = [model["vocab"][alphabet[b]] for b in range(256)]
        self.last = [model["vocab"][alphabet[b] + self.suffix] for b in range(256)]
        self._words = regex.compile(WORD_PATTERN)
        self.kept = KEPT
        self._special = re.compile("|".join(map(re.escape, self.special)))
        self._number = {v: str(v) for v in self.spelling}
        self._known_words: dict[str | int, tuple[str, str, int]] = {}      # lately used
        self._older_words: dict[str | int, tuple[str, str, int]] = {}
        self._known: dict[str, tuple[str, str, int]] = {}      # lately used
        self._older: dict[str, tuple[str, str, int]] = {}
        odd = "".join(f"{chr(a)}-{chr(b)}" for a, b in NOT_IN_WORDS)
        capitals = "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in MORE_CAPITALS)
        self._rare = re.compile(f"[{odd}{capitals}]")
        self._small = {c: small + c - a for a, b, small in MORE_CAPITALS for c in range(a, b + 1)}
        self._words_rare = regex.compile(WORD_PATTERN.replace(
            r"|[\p{L}]+|", rf"|(?:(?![{odd}])\p{{L}})+|").replace(r"|[\p{N}]|", rf"|(?![{odd}])\p{{N}}|").replace(
            r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{odd}])"))

    def symbols(self, characters: Iterable[str]) -> Iterator[int]:
        """Base tokens of a word's characters, one at a time; the last in its word-end form."""
        held = None
        for char in characters:
            for b in char.encode():
                if held is not None:
                    yield self.inner[held]
                held = b
        yield self.last[held]

    def stream(self, word: Iterable[str]) -> Iterator[int]:
        """Tokens of one word of any length, each as soon as it is stable; only the
        buffer is held."""
        if isinstance(word, str) and len(word) <= 48:     # its symbols at once
            data = word.encode()
            return self.transducer.tokens([*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]])
        return self.transducer.tokens(self.symbols(word))

    def words(self, text: str) -> Iterator[str]:
        """Words of a text without special strings, one at a time."""
        found = self._words
        if text.isascii():
            text = text.lower()
        else:
            # lower case letter by letter: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            if self._rare.search(text):
                text, found = text.translate(self._small), self._words_rare
        return map(regex_match, found.finditer(text))

    def piece(self, piece: str) -> Iterator[str | int]:
        """Words and special ids of a piece without ASCII white space."""
        if piece.isalpha() and piece.isascii():
            yield piece.lower()
            return
        start = 0
        if "<|" in piece:
            for match in self._special.finditer(piece):
                yield from self.words(piece[start:match.start()])
                yield self.special[match.group()]
                start = match.end()
        yield from self.words(piece[start:])

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for piece in _PIECE.finditer(text or ""):
            for word in self.piece(piece.group()):
                if isinstance(word, int):
                    out.append(word)
                else:
                    out.extend(self.stream(word))
        return out

    def remember(self, kept: int) -> None:
        """Hold at most ``kept`` spellings in half a table; larger tables are forgotten."""
        self.kept = kept
        for table in (self._known_words, self._older_words, self._known, self._older):
            if len(table) > kept:
                table.clear()

    def spelled_word(self, word: str | int) -> tuple[str, str, int]:
        """(ids as text, library decoding, number of ids) of a word, remembered."""
        known = self._known_words.get(word)
        if known is None:
            known = self._older_words.get(word)
            if known is None:
                ids = (word,) if isinstance(word, int) else [*self.stream(word)]
                known = (" ".join([self._number[i] for i in ids]), SpellingDecoder(self.spelling).feed_all(ids), len(ids))
            if isinstance(word, int) or len(word) <= 48:
                if len(self._known_words) >= self.kept:
                    self._older_words, self._known_words = self._known_words, {}
                self._known_words[word] = known
        return known

    def spelled(self, pieces: list[str]) -> list[tuple[str, str, int]]:
        """The same for pieces without ASCII white space."""
        known = self._known
        return [known.get(p) or self._spell(p) for p in pieces]

    def _spell(self, piece: str) -> tuple[str, str, int]:
        known = self._older.get(piece)
        if known is None:
            if piece.isalpha() and piece.isascii():
                known = self.spelled_word(piece.lower())
            else:
                words = [self.spelled_word(w) for w in self.piece(piece)]
                known = words[0] if len(words) == 1 else (
                    " ".join([w[0] for w in words]), " ".join([w[1] for w in words]), sum([w[2] for w in words]))
        if len(piece) <= 48:
            if len(self._known) >= self.kept:
                self._older = dict(self._known)
                self._known.clear()
            self._known[piece] = known
        return known


class SpellingDecoder:
    """Token spellings joined by one space, one id at a time."""

    def __init__(self, spelling: dict[int, str]):
        self.spelling, self.started = spelling, False

    def feed(self, token: int) -> str:
        text = self.spelling[token]
        if self.started:
            return " " + text
        self.started = True
        return text

    def feed_all(self, tokens: list[int]) -> str:
        """The same for several ids at once."""
        text = " ".join([self.spelling[t] for t in tokens])
        started, self.started = self.started, self.started or bool(tokens)
        return " " + text if started and tokens else text


class ByteDecoder:
    """Text behind the byte alphabet, one id at a time: an unfinished UTF-8
    sequence waits in the state; a word end becomes a space."""

    def __init__(self, tokenizer: WordTokenizer):
        self.tokenizer, self.special = tokenizer, set(tokenizer.special.values())
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        spelling, suffix = self.tokenizer.spelling[token], self.tokenizer.suffix
        if token in self.special:
            return self.utf8.decode(b"", True) + spelling
        ends = spelling.endswith(suffix)
        body = spelling[:-len(suffix)] if ends else spelling
        text = self.utf8.decode(bytes(self.tokenizer.byte_of[c] for c in body))
        return text + self.utf8.decode(b"", True) + " " if ends else text

    def end(self) -> str:
        return self.utf8.decode(b"", True)


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(name: str) -> WordTokenizer:
    """The named tokenizer, built once per worker."""
    if name not in _loaded:
        import public_tokenizers
        _loaded[name] = WordTokenizer(public_tokenizers.path(name))
    return _loaded[name]


def _encoded(model: WordTokenizer, text: str | None, ids: array | None) -> tuple[int, str, str]:
    """(number of ids, SHA-256 of the ids as text, SHA-256 of their library decoding);
    appends the ids if there is a place for them."""
    n, numbers_hash, text_hash, gap = 0, hashlib.sha256(), hashlib.sha256(), ""
    for part in _parts(text or ""):
        spelled = model.spelled(_PIECE.findall(part))
        if not all([s[2] for s in spelled]):      # white space beyond ASCII alone
            spelled = [s for s in spelled if s[2]]
        if spelled:
            numbers, spellings, sizes = zip(*spelled)
            n += sum(sizes)
            numbers = " ".join(numbers)
            if ids is not None:
                ids.extend(map(int, numbers.split(" ")))
            numbers_hash.update((gap + numbers).encode())
            text_hash.update((gap + " ".join(spellings)).encode())
            gap = " "
    return n, numbers_hash.hexdigest(), text_hash.hexdigest()


def encode(df: DataFrame, text_col: str, keep_ids: bool = True, name: str = TOKENIZER, remembered: int = KEPT) -> DataFrame:
    """All columns but the text, plus ``n_tokens``, ``ids`` (on request),
    ``ids_sha256`` and ``decoded_sha256``; earlier columns of those names are
    replaced.  Rows leave in small batches, so that ids never pile up.  ``remembered``
    bounds the spellings that a worker holds: fewer take less memory and more time."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c not in (text_col, "n_tokens", "ids", "ids_sha256", "decoded_sha256")]

    def run(batches):
        model = tokenizer(name)
        model.remember(remembered)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(start, ROWS_OUT)
                flat = array("i") if keep_ids else None
                rows = [_encoded(model, t, flat) for t in batch.column(len(kept)).to_pylist()]
                sizes = [r[0] for r in rows]
                columns = [*batch.columns[:len(kept)], pa.array(sizes, pa.int64())]
                if keep_ids:
                    offsets = pa.array([0, *itertools.accumulate(sizes)], pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(flat, np.int32))))
                columns += [pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=out)

    out = [*kept, "n_tokens", *(["ids"] if keep_ids else []), "ids_sha256", "decoded_sha256"]
    schema = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + ["n_tokens long"]
    schema += (["ids array<int>"] if keep_ids else []) + ["ids_sha256 string", "decoded_sha256 string"]
    return df.select(*kept, text_col).mapInArrow(run, ", ".join(schema))


def encode_digests(df: DataFrame, id_col: str, text_col: str, name: str = TOKENIZER) -> DataFrame:
    """Per row: the id, ``n_tokens``, SHA-256 of the ids and of their decoding."""
    return encode(df.select(id_col, text_col), text_col, keep_ids=False, name=name)


_SPACE = re.compile(r"[\t-\r ]")


def _parts(text: str, size: int = 1 << 18) -> Iterator[str]:
    """Parts of about ``size`` characters that end at white space."""
    start = 0
    while len(text) - start > size:
        cut = _SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def decode_ids(df: DataFrame, ids_col: str, out_col: str = "text", name: str = TOKENIZER) -> DataFrame:
    """All columns but the ids, plus the text behind them (lower case, words
    and symbols set apart by one space, as the vocabulary keeps no spacing)."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c not in (ids_col, out_col)]

    def run(batches):
        model = tokenizer(name)
        for batch in batches:
            texts = []
            for ids in batch.column(len(kept)).to_pylist():
                machine = ByteDecoder(model)
                texts.append("".join([*map(machine.feed, ids or []), machine.end()]).removesuffix(" "))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(texts)], names=[*kept, out_col])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    return df.select(*kept, ids_col).mapInArrow(run, f"{schema}{', ' if kept else ''}`{out_col}` string")
