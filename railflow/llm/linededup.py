"""Operator 7, line dedup: exact repeats of whole lines and of word runs, the
latter found by winnowing.

A document is its sequence of words, and its sequence of non-blank lines.  Two
kinds of repeats are deleted (``dedup_passages``); ``dedup_lines`` deletes only the
first kind:

* A run of whole lines with at least ``NOISE_WORDS`` words that occurs earlier.  From
  every line on, the fewest whole lines with that many words form a *gram*, up to
  every line too; together they cover each line of such a run.
* A run of at least ``NOISE_WORDS + WINDOW_WORDS`` words that occurs earlier, wherever
  it stands in its lines and however it is cut into lines.  Of the ``NOISE_WORDS``
  words from every word on, the smallest hash among ``WINDOW_WORDS + 1`` places in a
  row is selected (winnowing).  A repeated run selects the same places whatever
  surrounds it, so only windows whose selected hash occurs twice are candidates;
  each candidate window is hashed whole.

Grams and whole windows meet their first occurrence (by document, then place), which
holds all of them: a match never depends on what else that document has.  The words
of every later one are deleted, with the lines of which nothing is left and the blank
lines between them.  A repeat that overlaps its first occurrence in its own document
keeps the words of the first.

Everything is DataFrame code.  Before the last joins only hashes are shuffled, and
the texts that have candidates; a frequent gram is pre-aggregated, and its matches are
spread by skew-join splits, each against one first occurrence.

Defined results: a null text stays null; blank texts and texts shorter than a gram
stay as they are; a document whose every line repeats becomes the empty text; rows
equal in doc_id and text count as one document and get the same result; documents
are ordered by doc_id, nulls last, then by a hash of the text; an empty table gives
no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railflow.llm.common import SPACE_CHARS, WORD_GAP, fresh, let, stage, unstage

NOISE_WORDS = 8       # shorter matches are never looked at
WINDOW_WORDS = 42     # every repeated run of 8 + 42 = 50 words is found

KEY = ["id0", "th"]   # a document: its id (0 for null) and a hash that knows nulls
PLACE_BITS = 31       # low bits of a word's hash, for its place (an array cannot be longer)
RARE = 16             # one in so many hashes counts as least


def _key(doc_id: Column, text: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(0)).cast("long").alias("id0"), F.xxhash64(doc_id.isNull(), text).alias("th")]


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE_CHARS))


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per non-blank line: key, number, hash, words in it."""
    rows = docs.select(*_key(F.col(id_col), F.col(text_col)), F.col(id_col).isNull().alias("nul"),
                       F.posexplode(F.split(F.col(text_col), "\n")).alias("at", "line"))
    rows = rows.withColumn("line", _trimmed(F.col("line"))).where("line <> ''")
    return rows.select(*KEY, "nul", "at", F.size(F.split("line", WORD_GAP)).cast("long").alias("nw"),
                       F.xxhash64("line").alias("h")).dropDuplicates([*KEY, "at"])


def line_grams(lines: DataFrame, noise: int) -> DataFrame:
    """(g1, g2, nul, key, lo, hi): the grams that start and end at every line,
    with their first and last word."""
    by = Window.partitionBy(*KEY).orderBy("at")
    line = F.struct("h", "nw")
    # every line has a word: no gram has more than ``noise`` lines
    rows = lines.select(
        *KEY, "nul", "h", "nw", (F.sum("nw").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("nw")).alias("c"),
        F.collect_list(line).over(by.rowsBetween(0, noise - 1)).alias("on"),
        F.collect_list(line).over(by.rowsBetween(1 - noise, 0)).alias("upto"))

    def words(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda n, x: n + x["nw"])

    def gram(hashes: Column, lo: Column, hi: Column) -> Column:
        return F.struct(F.xxhash64(hashes, F.lit(1)).alias("g1"), F.xxhash64(hashes, F.lit(2)).alias("g2"),
                        lo.alias("lo"), hi.alias("hi"))

    def fewest(cut: Callable[[Column], Column], first: Callable[[Column], Column]) -> Column:
        """The gram of the fewest lines, ``cut(k)`` for k lines, with enough words."""
        enough = F.filter(F.transform(F.sequence(F.lit(1), F.lit(noise)), cut), lambda x: words(x) >= noise)
        return let(F.get(enough, F.lit(0)), lambda x: F.when(x.isNotNull(), gram(
            F.transform(x, lambda y: y["h"]), first(words(x)), first(words(x)) + words(x) - 1)))

    c, nw = F.col("c"), F.col("nw")
    own = F.array(gram(F.array("h"), c, c + nw - 1))     # a line with enough words is its own gram both ways
    pair = F.array(fewest(lambda k: F.slice("on", F.lit(1), k), lambda n: c),
                   fewest(lambda k: F.slice("upto", F.greatest(F.size("upto") - k + 1, F.lit(1)), k), lambda n: c + nw - n))
    rows = rows.select("nul", *KEY, F.explode_outer(F.when(nw >= noise, own).otherwise(F.array_compact(pair))).alias("g"))
    return rows.where("g IS NOT NULL").select("g.g1", "g.g2", "nul", *KEY, "g.lo", "g.hi")


def islands(ranges: DataFrame) -> DataFrame:
    """(key, runs): the ranges (key, lo, hi) of every document, in order and joined
    where they meet or overlap."""
    by = Window.partitionBy(*KEY).orderBy("lo", "hi")
    reach = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranges.withColumn("reach", reach).withColumn("opens", F.when(F.col("lo") <= F.col("reach") + 1, 0).otherwise(1))
    rows = rows.withColumn("island", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.groupBy(*KEY, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return rows.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("runs"))


def selected_places(docs: DataFrame, id_col: str, text_col: str, noise: int, run: int) -> DataFrame:
    """(g, context, nul, key, lo, hi): the places that winnowing selects.  A window of
    ``run`` words selects the place in it whose hash (of two words) is least; hashes below the
    ``1 / RARE`` quantile count as equal, and the first of equals is taken.  ``lo`` and
    ``hi`` are the first and last start of the windows that select the place, ``g`` is
    the hash of the ``noise`` words from it on, ``context`` that of all words of these
    windows: equal contexts hold equal windows."""
    # (a filter here would split every text twice)
    words = let(F.split(_trimmed(F.col(text_col)), WORD_GAP), lambda w: F.when(F.size(w) >= run, w))
    words = F.transform(words, lambda w: F.xxhash64(w))
    rows = docs.select(*_key(F.col(id_col), F.col(text_col)), F.col(id_col).isNull().alias("nul"), words.alias("w"))
    width, place = run - noise + 1, (1 << PLACE_BITS) - 1
    last, struct = F.size("w") - run, lambda at, lo, hi: F.struct(at.alias("at"), lo.alias("lo"), hi.alias("hi"))
    where = lambda v: v.bitwiseAND(F.lit(place)).cast("int")
    # hash in the high bits, place in the low ones; two words, as single ones can be too frequent
    rows = rows.withColumn("m", F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1)).bitwiseAND(F.lit(~place)).bitwiseOR(i.cast("long"))))
    least = F.filter(F.slice("m", F.lit(1), F.size("w") - noise + 1), lambda v: v < F.lit(-(1 << 63) + (1 << 64) // RARE))
    rows = rows.withColumn("low", F.transform(least, where))
    rows = rows.withColumn("ends", F.concat(F.array(F.lit(-1)), "low", F.array(last + width)))
    n = F.size("low")
    near = F.zip_with("low", F.slice("ends", F.lit(1), n), lambda at, before: struct(
        at, F.greatest(before + 1, at - (width - 1), F.lit(0)), F.least(at, last)))
    # windows without any such place: their least hashes one by one, equal neighbours joined
    gaps = F.filter(F.zip_with(F.slice("ends", F.lit(1), n + 1), F.slice("ends", F.lit(2), n + 1), lambda x, y: F.struct(
        (x + 1).alias("lo"), (y - width).alias("hi"))), lambda gap: gap["lo"] <= gap["hi"])

    def minima(gap: Column) -> Column:
        found = F.array_distinct(F.transform(F.sequence(gap["lo"], gap["hi"]), lambda s: F.array_min(F.slice("m", s + 1, width))))
        starts = lambda found: F.transform(found, lambda v, i: F.when(i == 0, gap["lo"]).when(
            v < F.get(found, i - 1), where(v) - (width - 1)).otherwise(where(F.get(found, i - 1)) + 1))
        return let(found, lambda found: let(starts(found), lambda lo: F.transform(found, lambda v, i: struct(
            where(v), F.get(lo, i), F.coalesce(F.get(lo, i + 1) - 1, gap["hi"])))))
    rows = rows.withColumn("spots", F.concat(F.filter(near, lambda x: x["lo"] <= x["hi"]), F.flatten(F.transform(gaps, minima))))
    rows = rows.withColumn("one", F.explode_outer(F.transform("spots", lambda x: F.struct(
        F.xxhash64(F.slice("w", x["at"] + 1, noise)).alias("g"),
        F.xxhash64(F.slice("w", x["lo"] + 1, x["hi"] - x["lo"] + run)).alias("context"),
        x["lo"].cast("long").alias("lo"), x["hi"].cast("long").alias("hi")))))
    return rows.where("one IS NOT NULL").select("one.g", "one.context", "nul", *KEY, "one.lo", "one.hi")


def window_grams(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, run: int) -> DataFrame:
    """(g1, g2, nul, key, lo, hi): every window of ``run`` words that starts in one of
    the ``spans`` (key, runs) of its document."""
    rows = docs.select(*_key(F.col(id_col), F.col(text_col)), F.col(id_col).isNull().alias("nul"), F.col(text_col).alias("t"))
    # words are hashed once, not in each of the windows that hold them
    rows = rows.join(spans, KEY).withColumn("w", F.transform(F.split(_trimmed(F.col("t")), WORD_GAP), lambda w: F.xxhash64(w)))
    starts = F.flatten(F.transform("runs", lambda r: F.sequence(r["lo"], r["hi"])))
    one = lambda s: let(F.slice("w", (s + 1).cast("int"), run), lambda x: F.struct(
        F.xxhash64(x).alias("g1"), F.xxhash64(x, F.lit(2)).alias("g2"), s.alias("lo")))
    rows = rows.select(*KEY, "nul", F.explode_outer(F.transform(starts, one)).alias("g"))
    return rows.select("g.g1", "g.g2", "nul", *KEY, "g.lo", (F.col("g.lo") + run - 1).alias("hi"))


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, noise: int, run: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, lo, hi): the words of every window of ``run`` words that occurs earlier,
    and the staged tables that this reads.

    Places with the same hash meet the first place with the same context: all windows
    of the others are repeats.  Only where a hash has several contexts, so that a match
    ends within one, are the windows of each context's first place compared one by
    one; a window's earliest occurrence is in the first place of its context.  (So are
    places that overlap the first of their context in its own document.)"""
    spark = docs.sparkSession
    spots = stage(spark, selected_places(docs, id_col, text_col, noise, run), "linededup-spots", "zstd")
    twice = spots.groupBy("g").agg(F.count("*").alias("times")).where("times > 1").select("g")
    spots_again = stage(spark, spots.join(twice, "g", "left_semi"), "linededup-repeats", "zstd")
    unstage(spots)
    firsts = spots_again.groupBy("g", "context").agg(F.min(F.struct("nul", *KEY, "lo")).alias("first"))
    contexts = firsts.groupBy("g").agg(F.count("*").alias("contexts"))
    rows = spots_again.join(firsts, ["g", "context"]).join(contexts, "g")
    same_doc = (F.col("id0") == F.col("first.id0")) & (F.col("th") == F.col("first.th"))
    is_first = same_doc & (F.col("lo") == F.col("first.lo"))
    overlaps = same_doc & ~is_first & (F.col("lo") < F.col("first.lo") + F.col("hi") - F.col("lo") + run)
    rows = rows.withColumn("kind", F.when(overlaps, "loop").when(~is_first, "later").when(
        F.col("contexts") > 1, "open").otherwise("only"))
    rows = stage(spark, rows.select("g", "context", "kind", *KEY, "lo", "hi"), "linededup-kinds", "zstd")
    unstage(spots_again)
    loops = rows.where("kind = 'loop'")
    looked = rows.where("kind IN ('open', 'loop')").unionByName(rows.where("kind = 'only'").join(
        loops.select("g", "context").distinct(), ["g", "context"], "left_semi"))
    windows = stage(spark, window_grams(docs, islands(looked.select(*KEY, "lo", "hi")), id_col, text_col, run), "linededup-windows", "zstd")
    whole = rows.where("kind = 'later'").select(*KEY, "lo", (F.col("hi") + run - 1).alias("hi"))
    return whole.unionByName(later_ones(windows)), [rows, windows]


def later_ones(grams: DataFrame) -> DataFrame:
    """(key, lo, hi): the words of every gram that occurs earlier."""
    firsts = grams.groupBy("g1", "g2").agg(
        F.count("*").alias("times"), F.min(F.struct("nul", *KEY, "lo")).alias("first")).where("times > 1")
    firsts = firsts.select("g1", "g2", F.col("first.id0").alias("f_id0"), F.col("first.th").alias("f_th"),
                           F.col("first.lo").alias("f_lo"))
    same_doc = (F.col("id0") == F.col("f_id0")) & (F.col("th") == F.col("f_th"))
    found = grams.join(firsts, ["g1", "g2"]).where(~(same_doc & (F.col("lo") == F.col("f_lo"))))
    past = F.col("f_lo") + F.col("hi") - F.col("lo") + 1
    lo = F.when(same_doc, F.greatest(F.col("lo"), past)).otherwise(F.col("lo"))
    return found.select(*KEY, lo.alias("lo"), "hi")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE_WORDS,
                  window: int = WINDOW_WORDS, passages: bool = False) -> DataFrame:
    """(id0, th, runs): the runs of words [lo, hi] to delete per document, in
    order and apart."""
    spark = docs.sparkSession
    grams = stage(spark, line_grams(lines_of(docs, id_col, text_col), noise), "linededup-lines", "zstd")
    found, done = later_ones(grams), [grams]
    if passages:
        windows, read = repeated_windows(docs, id_col, text_col, noise, noise + window)
        found, done = found.unionByName(windows), [grams, *read]
    runs = stage(spark, islands(found.where("lo <= hi")), "linededup-runs", "zstd")
    unstage(*done)
    return runs


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str = "n_removed",
                noise: int = NOISE_WORDS, window: int = WINDOW_WORDS, passages: bool = False) -> DataFrame:
    """All rows with the later repeated runs deleted from their texts, and the
    number of lines that were deleted or cut in column ``removed`` (a line cut at
    several places counts for each).  Without ``passages`` only whole lines go."""
    names = {c: fresh(docs, c) for c in ("run_id", "run_th", "runs", "doc_id0", "doc_th", "words", "end", "out")}
    run_id, run_th, runs_, doc_id0, doc_th, words_, end_, out_ = names.values()
    runs = repeated_runs(docs, id_col, text_col, noise, window, passages).select(
        F.col("id0").alias(run_id), F.col("th").alias(run_th), F.col("runs").alias(runs_))
    keyed = docs.select("*", *[k.alias(n) for n, k in zip((doc_id0, doc_th), _key(F.col(id_col), F.col(text_col)))])
    out = keyed.join(runs, (F.col(doc_id0) == F.col(run_id)) & (F.col(doc_th) == F.col(run_th)), "left")
    name, text, space, all_runs, all_words = fresh(docs, removed), F.col(text_col), F.lit(SPACE_CHARS), F.col(runs_), F.col(words_)
    hit = all_runs.isNotNull()
    # each step is a column of its own, so that no lambda computes it again
    out = out.withColumn(words_, F.when(hit, F.regexp_extract_all(text, F.lit(f"{WORD_GAP[:-1]}*[^\\x20\\x09-\\x0D]+"), F.lit(0))))
    out = out.withColumn(end_, F.when(hit, F.regexp_extract(text, f"{WORD_GAP[:-1]}*\\z", 0)))
    piece = lambda lo, hi: F.slice(all_words, (lo + 1).cast("int"), F.greatest(hi - lo + 1, F.lit(0)).cast("int"))
    lead = lambda word: F.left(word, F.char_length(word) - F.char_length(F.ltrim(word, space)))
    n_words = F.size(all_words).cast("long")

    def join_after(run: Column, i: Column) -> Column:
        """What stands for a run and the words after it."""
        last = run["hi"] + 1 >= n_words
        before = lead(F.get(all_words, run["lo"].cast("int")))
        after = F.when(last, F.col(end_)).otherwise(lead(F.get(all_words, (run["hi"] + 1).cast("int"))))
        starts = (run["lo"] == 0) | F.contains(before, F.lit("\n"))
        ends = last | F.contains(after, F.lit("\n"))
        upto = F.regexp_extract(before, r"(?s)\A.*\n", 0)       # all lines before, with the line end
        below = F.regexp_replace(after, r"\A[^\n]*\n", "")      # all lines after
        inside = F.exists(piece(run["lo"] + 1, run["hi"]), lambda w: F.contains(w, F.lit("\n")))
        whole = F.when(F.contains(after, F.lit("\n")), F.concat(upto, below)).otherwise(F.regexp_replace(upto, r"\n\z", ""))
        gap = F.when(starts & ends, whole).when(starts, before).when(ends, after).when(inside, F.lit("\n")).otherwise(after)
        then = F.coalesce(F.get(all_runs, i + 1)["lo"], n_words) - 1
        first = F.when(last, F.lit("")).otherwise(F.ltrim(F.get(all_words, (run["hi"] + 1).cast("int")), space))
        tail = F.when(then + 1 >= n_words, F.when(last, F.lit("")).otherwise(F.col(end_))).otherwise(F.lit(""))
        return F.concat(gap, first, F.array_join(piece(run["hi"] + 2, then), ""), tail)

    left = F.concat(F.array_join(piece(F.lit(0), F.get(all_runs, F.lit(0))["lo"] - 1), ""),
                    F.array_join(F.transform(all_runs, join_after), ""))
    lines = F.aggregate(all_runs, F.lit(0), lambda n, run: n + 1 + F.size(
        F.filter(piece(run["lo"] + 1, run["hi"]), lambda w: F.contains(w, F.lit("\n")))))
    # out of a generator, so that a filter on the result does not hold all this once more
    result = F.struct(F.when(hit, left).otherwise(text).alias("text"), F.when(hit, lines).otherwise(0).alias("lines"))
    out = out.select(*[f"`{c}`" for c in docs.columns], F.explode_outer(F.array(result)).alias(out_))
    return out.select(*[F.col(out_)["text"].alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                      F.col(out_)["lines"].alias(name))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str = "n_removed",
                   noise: int = NOISE_WORDS, window: int = WINDOW_WORDS) -> DataFrame:
    """``dedup_lines`` that also deletes word runs of ``noise + window`` words and
    more that are not whole lines."""
    return dedup_lines(docs, id_col, text_col, removed, noise, window, passages=True)
