"""Operator 9, personal data: bootstrapped contextual extraction.

Base: four patterns (email, ip, card, phone) with their checks give certain spans.
Method: these entities are seeds.  Every entity, and every other number or address
in the texts that looks like an identifier, is an *instance*; the words around it and
its shape are lexical *patterns*.  In the graph of patterns and instances a pattern's
precision for a kind is the confidence of its instances over their number, and an
instance's confidence joins the precise patterns that it occurs in.  The two are
computed in turn for ``ROUNDS`` rounds; patterns need ``LEAST_SEEDS`` confident
instances and a precision of ``PRECISE``.  Instances that reach ``CONFIDENT`` through
at least one pattern of context are added, wherever a confident context holds them.
Base spans always stay.

Everything is DataFrame code.  Texts are read once; only entities move after that.
Frequent patterns and instances are pre-aggregated; edges are distinct.

The regular expressions use possessive quantifiers and look-behinds: the same
matches as the plain forms, but no backtracking over long runs and no deep recursion.

Defined results: a null or blank text has no spans; a very long text is searched
whole; repeated rows are searched each; an empty table gives no rows; extra columns
are ignored.  Offsets count code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railflow.llm.common import stage, unstage

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
LEAST_SEEDS = 8
PRECISE = 0.9
CONFIDENT = 0.9
CONTEXT_CHARS = 48

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Identifier-like: number groups, or addresses with an @ or a spelled-out one.
LIKE = r"(?<![A-Za-z0-9._%+-])(?:[(+]?[0-9](?:[0-9().+/-]| (?=[0-9(]))*+|[A-Za-z0-9._%+-]++(?:@|\(at\)|\[at\])[A-Za-z0-9.-]++)"
LEAST_DIGITS = 6      # of an identifier-like number

SPAN = "struct<start:int,kind_no:int,end:int,body:string,left:string,right:string>"


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "card":
        turned = F.reverse(digits)
        every = F.transform(F.split(turned, ""), lambda d, i: F.when(
            i % 2 == 1, F.translate(d, "0123456789", "0246813579")).otherwise(d).cast("int"))
        total = F.aggregate(every, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
        return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)
    return F.lit(True)


def _valid_span(kind: str):
    return lambda s: _valid(kind, s["body"])


def _of_kind(number: int):
    return lambda s: s["kind_no"] == number


def _with_spans(df: DataFrame, text: str, name: str, regex: str, kind_no: int, gate: Column) -> DataFrame:
    """Add ``name``: the matches of ``regex`` in order, with positions from the
    lengths of what lies between them, and the words around them."""
    df = df.withColumn("_m", F.when(gate, F.regexp_extract_all(text, F.lit(regex), F.lit(0))))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(text, regex, -1)))
    step = lambda at, i: F.struct(
        (at["pos"] + F.length(F.get("_p", i)) + F.length(F.get("_m", i))).alias("pos"),
        F.concat(at["out"], F.array(F.struct(
            (at["pos"] + F.length(F.get("_p", i))).alias("start"), F.lit(kind_no).alias("kind_no"),
            (at["pos"] + F.length(F.get("_p", i)) + F.length(F.get("_m", i))).alias("end"),
            F.get("_m", i).alias("body"), F.right(F.get("_p", i), F.lit(CONTEXT_CHARS)).alias("left"),
            F.left(F.get("_p", i + 1), F.lit(CONTEXT_CHARS)).alias("right")).cast(SPAN))).alias("out"))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{SPAN}>").alias("out"))
    spans = F.aggregate(F.sequence(F.lit(0), F.size("_m") - 1), start, step, lambda at: at["out"])
    return df.withColumn(name, F.coalesce(F.when(F.size("_m") > 0, spans), F.array().cast(f"array<{SPAN}>"))).drop("_m", "_p")


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, base, others): the certain spans in order, and the other
    identifier-like ones."""
    df = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                     F.coalesce(text_col, F.lit("")).alias("text"))
    digit = F.col("text").rlike("[0-9]")
    gates = {"email": F.contains("text", F.lit("@")), "ip": digit, "card": digit, "phone": F.contains("text", F.lit("+"))}
    for number, kind in enumerate(KINDS):
        df = _with_spans(df, "text", f"_{kind}", PATTERNS[kind], number, gates[kind])
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", _valid_span(kind)))
    df = _with_spans(df, "text", "_like", LIKE, -1, digit | F.contains("text", F.lit("@")) | F.contains("text", F.lit("at")))
    df = df.withColumn("base", F.array_sort(F.concat(*[F.col(f"_{k}") for k in KINDS])))
    is_like = lambda s: (F.length(F.regexp_replace(s["body"], "[^0-9]", "")) >= LEAST_DIGITS) | s["body"].rlike(
        r"@|\(at\)|\[at\]")
    df = df.withColumn("others", F.filter("_like", lambda s: is_like(s) & ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    return df.select("rid", "doc_id", "base", "others")


def _occurrences(found: DataFrame) -> DataFrame:
    """One row per entity: instance, kind (null if unknown) and its patterns."""
    rows = found.select("rid", F.explode(F.concat("base", "others")).alias("s")).select("rid", "s.*")
    # closing brackets and full stops at the end of a number belong to the sentence
    trimmed = F.when(F.col("kind_no") < 0, F.regexp_replace("body", r"[().+/-]+$", "")).otherwise(F.col("body"))
    rows = rows.withColumn("end", F.col("end") - F.length("body") + F.length(trimmed)).withColumn("body", trimmed)
    number = ~F.col("body").rlike(r"@|\(at\)|\[at\]")
    instance = F.when(number, F.regexp_replace("body", "[^0-9]", "")).otherwise(F.lower("body"))
    left = F.lower(F.regexp_extract("left", r"(\S+)\s*$", 1))
    right = F.lower(F.regexp_extract("right", r"^\S*\s+(\S+)", 1))
    shape = F.regexp_replace(F.regexp_replace("body", "[0-9]", "9"), "[A-Za-z]+", "a")
    rows = rows.withColumns({"instance": instance, "left": left, "right": right, "shape": shape})
    context = F.array_compact(F.array(
        F.when(F.col("left") != "", F.concat(F.lit("L:"), "left")),
        F.when(F.col("right") != "", F.concat(F.lit("R:"), "right")),
        F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B:"), "left", F.lit(" "), "right"))))
    kind = F.when(F.col("kind_no") >= 0, F.col("kind_no"))
    return rows.select("rid", "start", "end", "instance", kind.alias("kind_no"), context.alias("context"),
                       F.concat(F.lit("S:"), "shape").alias("shape"))


def discover(found: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, precise: float = PRECISE,
             confident: float = CONFIDENT) -> DataFrame:
    """(rid, start, end, kind_no) of the added spans."""
    spark = found.sparkSession
    rows = stage(spark, _occurrences(found), "pii-occurrences")
    edges = stage(spark, rows.select("instance", F.explode(F.concat("context", F.array("shape"))).alias("pattern"))
                  .distinct(), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size"))
    known = rows.where("kind_no IS NOT NULL").groupBy("instance").agg(F.min("kind_no").alias("kind_no")).withColumn(
        "belief", F.lit(1.0))
    seeds = known = stage(spark, known, "pii-seeds")
    patterns, passed = None, []
    for _ in range(rounds):
        support = edges.join(known, "instance").groupBy("pattern", "kind_no").agg(F.sum("belief").alias("support"))
        precision = F.col("support") / F.col("size")
        patterns = support.where(F.col("support") >= least_seeds).join(sizes, "pattern").withColumn(
            "precision", precision).where(F.col("precision") >= precise).select("pattern", "kind_no", "precision")
        patterns = stage(spark, patterns, "pii-patterns")
        passed += [patterns, known]
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("precision"), F.lit(1e-6)))))
        context = F.max(~F.col("pattern").startswith("S:"))
        new = edges.join(seeds.select("instance"), "instance", "left_anti").join(patterns, "pattern").groupBy(
            "instance", "kind_no").agg((1 - doubt).alias("belief"), context.alias("context")).where(
            F.col("context") & (F.col("belief") >= confident))
        best = new.groupBy("instance").agg(F.max_by("kind_no", F.struct("belief", -F.col("kind_no"))).alias("kind_no"),
                                           F.max("belief").alias("belief"))
        known = stage(spark, seeds.unionByName(best), "pii-known")
    added = known.join(seeds.select("instance"), "instance", "left_anti").select("instance", F.col("kind_no").alias("new_kind"))
    spots = rows.where("kind_no IS NULL").join(added, "instance").select(
        "rid", "start", "end", "new_kind", F.explode("context").alias("pattern"))
    held = patterns.select("pattern", F.col("kind_no").alias("new_kind"))
    spots = stage(spark, spots.join(held, ["pattern", "new_kind"], "left_semi").select(
        "rid", "start", "end", F.col("new_kind").alias("kind_no")).distinct(), "pii-added")
    unstage(rows, edges, seeds, known, *passed)
    return spots


def _line(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per document: counts of the base spans by kind, ``base_sha256`` over
    them, and ``spans``: all spans, base and added."""
    found = stage(docs.sparkSession, base_spans(docs, id_col, text_col), "pii-spans")
    added = discover(found, **limits).groupBy("rid").agg(F.collect_list(F.struct("start", "kind_no", "end")).alias("added"))
    out = found.select("rid", "doc_id", F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"))).alias("base")).join(added, "rid", "left")
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("added", none)))
    counts = [F.size(F.filter("base", _of_kind(n))).cast("long").alias(f"n_{k}")
              for n, k in enumerate(KINDS)]
    return out.select(F.col("doc_id").alias(id_col), *counts, F.sha2(_line(F.col("base")), 256).alias("base_sha256"),
                      _line(spans).alias("spans"))
