"""Operator 13, SentencePiece encoding and decoding: exact merges by backtracking.

The vocabulary is of the merge type: of all neighbouring symbols whose joined text is
a piece, the pair with the best score is joined, the leftmost among equals.  The result
is the only sequence of pieces in which every two neighbours are **compatible**: merging
the characters of the two anew gives these two again.  So it is found without a queue:

* an Aho-Corasick automaton over the pieces gives the longest piece at every place;
* from left to right the longest piece is taken that is compatible with the one before;
* where no piece fits, the last one is taken back for its next shorter prefix, and the
  place goes into a bitfield of failed positions, which are never tried again.

So every position fails at most once, and the work is linear in the text.

Before that a text is prepared as the vocabulary demands: a space before it, spaces
written as U+2581.  No piece has that sign behind another character, nor a line end, so
a text falls apart before every run of the sign and every line end, exactly; the codes of such units are remembered per
worker (at most ``2 * KEPT``, the long unused ones forgotten).  So does a unit before its last ASCII signs and digits, if no
piece has one of them behind the character before: both sides are remembered for other units.  Pieces of this sign alone all have one score, below all
others: a run is merged last, from the left.  A character without a piece becomes its
bytes' pieces.

Decoding is a state machine: ids go in one at a time, bytes wait until a character is
complete, the sign becomes a space, and the first one is left out.

Defined results: null and empty texts have no pieces and decode to the empty text;
very long texts are cut before spaces into parts, and a very long unit costs nine bytes
a character; repeated rows are encoded each; an empty table gives no rows;
extra columns are kept by ``encode`` and ignored by ``encode_digests``.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from railflow.llm.common import ship

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
KEPT = 200_000          # units remembered by a worker before the older half is forgotten
PAIRS = 300_000         # pairs of pieces remembered by a worker
LONGEST_KEPT = 64       # characters of a unit that is remembered
ROWS_OUT = 512          # rows in a batch of results
PART = 1 << 18          # characters of a text that are split into units at once
UNKNOWN_TEXT = " ⁇ "    # what the library writes for the unknown id (fixed value)

_UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n[^{SPACE}\n]*")
_OPENS = SPACE + "\n"     # what a unit with a sign or line end of its own starts with
_CUT = re.compile("(?<! ) ")
_NONE: dict[str, bool] = {}                     # what is known of a piece without known pairs
_SIGNS = string.punctuation + string.digits     # what may end a unit apart from the rest

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class Pieces:
    """A vocabulary of scored pieces, ready for encoding and decoding."""

    def __init__(self, pieces: dict[str, int], scores: dict[str, float], byte_ids: list[int], silent: set[int], unknown: int):
        import ahocorasick
        self.ids, self.byte_ids, self.silent, self.unknown = pieces, byte_ids, silent, unknown
        self.text_of = {i: p for p, i in pieces.items()}
        self.byte_of = {i: b for b, i in enumerate(byte_ids)}
        self._number = {i: str(i) for i in (*pieces.values(), *byte_ids, unknown)}
        self._rank = {p: -s for p, s in scores.items()}
        self._check(scores)
        found = ahocorasick.Automaton()
        self._made: dict[str, tuple[float, str, str]] = {}      # reached pieces: rank, and the two that the last merge joins
        self.reached = {p for p in pieces if p.strip(SPACE) and self._reach(p)}
        self._in_order = all(rank > max(self._made[x][0] for x in parts if x in self._made)
                             for rank, *parts in self._made.values() if any(x in self._made for x in parts))
        for p in self.reached:
            found.add_word(p, (len(p), p))
        found.make_automaton()
        self._found = found
        self._shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.reached or p[:n] == SPACE), None)
                         for p in self.reached}
        self._before_signs = {a for p in pieces for a, b in zip(p, p[1:]) if b in _SIGNS}     # no cut behind these
        self._pairs: dict[str, dict[str, bool]] = {}
        self._n_pairs = 0
        self._known: dict[str, tuple[int, str, str]] = {}       # lately used units
        self._older: dict[str, tuple[int, str, str]] = {}
        self._ends: dict[str, tuple[int, str, str]] = {}

    def _check(self, scores: dict[str, float]) -> None:
        words = [s for p, s in scores.items() if p.strip(SPACE)]
        blanks = {s for p, s in scores.items() if not p.strip(SPACE)}
        if len({*words}) < len(words) or len(blanks) > 1 or (blanks and max(blanks) >= min(words)):
            raise ValueError("pieces of characters need different scores, blank ones one lower score")
        if any(SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE)) or not {*p} <= self.ids.keys()
               for p in scores) or any("\n" in p for p in self.ids):
            raise ValueError("a piece goes over a space or line end, or has a character that is no piece")

    def merge(self, symbols: list[str], steps: list[list[str]] | None = None) -> list[str]:
        """The merges as they are defined, on few symbols; ``steps``: gets the symbols before each."""
        rank, none, out = self._rank, float("inf"), symbols[:]
        ranks = [rank.get(a + b, none) for a, b in zip(out, out[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            if steps is not None:
                steps.append(out[:])
            out[i:i + 2] = (out[i] + out[i + 1],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get(out[i - 1] + out[i], none)
            if i < len(ranks):
                ranks[i] = rank.get(out[i] + out[i + 1], none)
        return out

    def _reach(self, piece: str) -> bool:
        """Whether the merges of its characters end with the piece."""
        if len(piece) == 1:
            return True
        steps = [[*piece]]
        done = self.merge(steps[0], steps) == [piece]
        if done:
            self._made[piece] = (self._rank[piece], *steps[-1])
        return done

    def _apart(self, left: str, right: str) -> bool:
        """Whether no merge goes over the border of two reached pieces.  Where a piece
        ranks behind its parts, merges run by rank: the later one is undone, and what
        then met at the border may not rank before it (the left one of equals first)."""
        if not self._in_order:
            return self.merge([*left, *right]) == [left, right]
        rank, made, end = self._rank.get, self._made.get, (float("-inf"), "", "")
        of_left, of_right = made(left, end), made(right, end)
        if rank(left + right) is not None:
            return False
        while True:
            if of_left[0] > of_right[0]:
                limit, _, left = of_left
                of_left = made(left, end)
                if rank(left + right, limit) < limit:
                    return False
            elif of_right is end:
                return True
            else:
                limit, right, _ = of_right
                of_right = made(right, end)
                if (found := rank(left + right)) is not None and found <= limit:
                    return False

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both anew gives both again; remembered."""
        known = self._apart(left, right)
        if self._n_pairs >= PAIRS:
            self._pairs.clear()
            self._n_pairs = 0
        self._pairs.setdefault(left, {})[right] = known
        self._n_pairs += 1
        return known

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all pieces."""
        longest = list(text)
        for end, (size, piece) in self._found.iter(text):
            longest[end - size + 1] = piece      # later ends are longer
        pairs, shorter, n = self._pairs, self._shorter, len(text)
        failed, none_failed = bytearray(n // 8 + 1), True
        taken: list[str] = []
        at, piece, before, behind = 0, longest[0], None, _NONE
        while True:
            end = at + len(piece)
            if none_failed or not failed[end >> 3] >> (end & 7) & 1:
                fits = before is None or behind.get(piece)
                if fits is None:
                    fits = self.compatible(before, piece)
                    behind = pairs.get(before, _NONE)
                if fits:
                    taken.append(piece)
                    if end == n:
                        return taken
                    at, before, piece = end, piece, longest[end]
                    behind = pairs.get(before, _NONE)
                    continue
            piece = shorter.get(piece)
            while piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                none_failed = False
                last = taken.pop()
                at -= len(last)
                before = taken[-1] if taken else None
                behind = pairs.get(before, _NONE)
                piece = shorter.get(last)

    def blanks(self, n: int) -> list[str]:
        """Pieces of a run of n signs: always the leftmost pair that has a piece."""
        done: list[str] = []
        for _ in range(n):
            done.append(SPACE)
            while len(done) > 1 and done[-2] + done[-1] in self.ids:
                done[-2:] = (done[-2] + done[-1],)
        return done

    def _characters(self, text: str) -> Iterator[int]:
        """Ids of a text without a run of signs: known stretches, bytes of the rest."""
        if self._plain(text):
            yield from map(self.ids.__getitem__, self.backtrack(text))
            return
        start = 0
        for i, char in enumerate(text):
            if char not in self.ids:
                if start < i:
                    yield from map(self.ids.__getitem__, self.backtrack(text[start:i]))
                yield from (self.byte_ids[b] for b in char.encode()) if self.byte_ids else (self.unknown,)
                start = i + 1
        if start < len(text):
            yield from map(self.ids.__getitem__, self.backtrack(text[start:]))

    def unit(self, unit: str) -> list[int]:
        """Ids of a unit: a run of signs and the characters behind it, where a single
        sign is left out; or a line end and the characters behind it."""
        if unit[0] == "\n":
            return [*self._characters("\n"), *(self._characters(unit[1:]) if len(unit) > 1 else ())]
        body = unit.lstrip(SPACE)
        signs = len(unit) - len(body)
        if not signs:
            return list(self._characters(SPACE + unit))
        if not body:
            return [self.ids[p] for p in self.blanks(signs)]
        out = list(self._characters(unit[signs - 1:]))
        if out[0] == self.ids.get(SPACE):
            del out[0]
        else:
            signs -= 1
        return [self.ids[p] for p in self.blanks(signs)] + out

    def units(self, text: str | None) -> Iterator[list[str]]:
        """Units of the prepared text, part by part."""
        start, size = 0, len(text or "")
        while start < size:
            cut = _CUT.search(text, start + PART) if size - start > PART else None
            end = cut.start() if cut else size
            part = text[start + (start > 0):end]      # the space before the part is its first sign
            start = end
            words = part.replace("\n", " \n").split(" ")
            if "" in words or SPACE in part:
                words = [u[1:] if u[0] == SPACE and len(u) > 1 and u[1] != SPACE else u
                         for u in _UNIT.findall(SPACE + part.replace(" ", SPACE))]
            yield words

    def _plain(self, text: str) -> bool:
        return self.ids.keys() >= {*text}

    def encode(self, text: str | None) -> list[int]:
        return [i for units in self.units(text) for u in units for i in self.unit(u)]

    def spelled(self, units: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by commas, text behind them) of every unit."""
        return [self._known.get(u) or self._spell(u) for u in units]

    def _spell(self, unit: str) -> tuple[int, str, str]:
        head = unit.rstrip(_SIGNS) if unit[-1] in _SIGNS and len(unit) <= LONGEST_KEPT else ""
        if head and head[-1] not in self._before_signs:      # both sides are remembered, not the unit
            n, numbers, text = self._known.get(head) or self._spell(head)
            end = unit[len(head):]
            m, more, rest = self._ends.get(end) or self._spell_end(end)
            return n + m, f"{numbers},{more}", text + rest
        known = self._older.get(unit)
        if known is None:
            if unit[0] not in _OPENS and self._plain(unit):
                known = self._code([self.ids[p] for p in self.backtrack(SPACE + unit)])
            else:
                known = self._code(self.unit(unit))
        if len(unit) <= LONGEST_KEPT:
            if len(self._known) >= KEPT:
                self._older = self._known
                self._known = {}
            self._known[unit] = known
        return known

    def _spell_end(self, signs: str) -> tuple[int, str, str]:
        if len(self._ends) >= KEPT:
            self._ends.clear()
        ids = [self.ids[p] for p in self.backtrack(signs)] if self._plain(signs) else list(self._characters(signs))
        known = self._ends[signs] = self._code(ids)
        return known

    def _code(self, ids: list[int]) -> tuple[int, str, str]:
        machine = Decoder(self, inside=True)
        return len(ids), ",".join([self._number[i] for i in ids]), machine.feed_all(ids) + machine.end()


class Decoder:
    """Text behind ids, one at a time; ``inside`` a text the first sign stays."""

    def __init__(self, pieces: Pieces, inside: bool = False):
        self.pieces, self.first, self.utf8 = pieces, not inside, None

    def feed(self, token: int) -> str:
        byte = self.pieces.byte_of.get(token)
        if byte is not None:
            self.first = False
            if self.utf8 is None:
                self.utf8 = codecs.getincrementaldecoder("utf-8")("each_byte")
            return self.utf8.decode(bytes([byte]))
        before = self.end()
        if token in self.pieces.silent:
            return before
        piece = UNKNOWN_TEXT if token == self.pieces.unknown else self.pieces.text_of[token].replace(SPACE, " ")
        if self.first:
            self.first, piece = False, piece.removeprefix(" ") if token != self.pieces.unknown else piece
        return before + piece

    def feed_all(self, tokens: list[int]) -> str:
        """The same for several ids; at once where none of them has a state."""
        text_of = self.pieces.text_of
        if not self.first and text_of.keys() >= {*tokens}:
            return self.end() + "".join([text_of[t] for t in tokens]).replace(SPACE, " ")
        return "".join(map(self.feed, tokens))

    def end(self) -> str:
        if self.utf8 is None:      # no byte so far
            return ""
        out = self.utf8.decode(b"", True)
        self.utf8.reset()
        return out


_loaded: dict[str, Pieces] = {}


def vocabulary(name: str) -> Pieces:
    """The named model's pieces, built once per worker."""
    if name not in _loaded:
        import public_tokenizers
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        probe = "  a\t\n  ﬁ "
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("only models that keep texts as they are")
        every = range(model.get_piece_size())
        bytes_ = [i for i in every if model.is_byte(i)]
        silent = {i for i in every if model.is_control(i)}
        plain = [i for i in every if not (model.is_byte(i) or model.is_unknown(i) or i in silent or model.is_unused(i))]
        _loaded[name] = Pieces({model.id_to_piece(i): i for i in plain}, {model.id_to_piece(i): model.get_score(i) for i in plain},
                               bytes_, silent, model.unk_id())
    return _loaded[name]


def _digests(pieces: Pieces, text: str | None, ids: array | None) -> tuple[int, str, str]:
    """(number of ids, SHA-256 of the ids, of the decoded text); appends the ids."""
    n, numbers_hash, text_hash, first = 0, hashlib.sha256(), hashlib.sha256(), True
    for units in pieces.units(text):
        sizes, numbers, texts = zip(*pieces.spelled(units))
        n += sum(sizes)
        numbers, decoded = ",".join(numbers), "".join(texts)
        if ids is not None:
            ids.extend(map(int, numbers.split(",")))
        numbers_hash.update((numbers if first else "," + numbers).encode())
        text_hash.update((decoded.removeprefix(" ") if first else decoded).encode())
        first = False
    return n, numbers_hash.hexdigest(), text_hash.hexdigest()


def encode(df: DataFrame, text_col: str, keep_ids: bool = True, name: str = MODEL) -> DataFrame:
    """All columns but the text, plus ``n_tokens``, ``ids`` (on request),
    ``ids_sha256`` and ``decoded_sha256``; earlier columns of those names are replaced."""
    ship(df.sparkSession)
    new = ["n_tokens", *(["ids"] if keep_ids else []), "ids_sha256", "decoded_sha256"]
    kept = [c for c in df.columns if c not in (text_col, *new)]

    def run(batches):
        pieces = vocabulary(name)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(start, ROWS_OUT)
                flat = array("i") if keep_ids else None
                rows = [_digests(pieces, t, flat) for t in batch.column(len(kept)).to_pylist()]
                columns = [*batch.columns[:len(kept)], pa.array([r[0] for r in rows], pa.int64())]
                if keep_ids:
                    offsets = pa.array(np.cumsum([0, *[r[0] for r in rows]]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(flat, np.int32))))
                columns += [pa.array([r[i] for r in rows], pa.string()) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    types = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"{c} {types[c]}" for c in new]
    return df.select(*[f"`{c}`" for c in kept], text_col).mapInArrow(run, ", ".join(schema))


def encode_digests(df: DataFrame, id_col: str, text_col: str, name: str = MODEL) -> DataFrame:
    """Per row: the id, ``n_tokens``, SHA-256 of the ids and of their decoding."""
    return encode(df.select(id_col, text_col), text_col, keep_ids=False, name=name)


def decode_ids(df: DataFrame, ids_col: str, out_col: str = "text", name: str = MODEL) -> DataFrame:
    """All columns but the ids, plus the text behind them."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c not in (ids_col, out_col)]

    def run(batches):
        pieces = vocabulary(name)
        for batch in batches:
            texts = []
            for ids in batch.column(len(kept)).to_pylist():
                machine = Decoder(pieces)
                texts.append(machine.feed_all(ids or []) + machine.end())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(texts, pa.string())], names=[*kept, out_col])

    schema = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{out_col}` string"]
    return df.select(*[f"`{c}`" for c in kept], ids_col).mapInArrow(run, ", ".join(schema))
