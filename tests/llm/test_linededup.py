"""Line dedup: what is deleted repeats earlier, what repeats is deleted."""

from pathlib import Path

from pyspark.sql import functions as F

from railflow.llm import common
from railflow.llm import linededup as L

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def solid(text):
    return [x for x in (line.strip(SPACE) for line in (text or "").split("\n")) if x]


def runs(lines, words):
    """Every shortest run of whole lines with at least ``words`` words: (start, end, lines)."""
    for a in range(len(lines)):
        total = 0
        for b in range(a, len(lines)):
            total += len(lines[b].encode().split())
            if total >= words:
                yield a, b, tuple(lines[a:b + 1])
                break


def check(before, after, noise=L.NOISE_WORDS, guarantee=L.NOISE_WORDS + L.WINDOW_WORDS):
    """before, after: {doc_id: text}"""
    grams, whole = {}, {}
    for doc in sorted(before):
        for a, b, run in runs(solid(before[doc]), noise):
            grams.setdefault(run, (doc, a))
    for doc in sorted(after):           # the guarantee, and nothing new
        for _, _, run in runs(solid(after[doc]), guarantee):
            assert whole.setdefault(run, doc) == doc, (doc, run[0][:60])
        left = solid(after[doc])
        rest = iter(solid(before[doc]))
        assert all(line in rest for line in left)      # a subsequence
    kept_lines = {line for text in after.values() for line in solid(text)}
    for doc, text in before.items():
        lines = solid(text)
        if lines == solid(after[doc]):
            assert text == after[doc]
            continue
        repeated = set()
        for a, b, run in runs(lines, noise):
            if grams[run] != (doc, a):
                repeated.update(range(a, b + 1))
        assert repeated
        # every line's content stays somewhere
        assert set(lines) <= kept_lines


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.dedup_lines(docs)
    assert out.count() == docs.count()
    check(texts(docs), texts(out))


def lines(n, tag, width=6):
    return [" ".join(f"{tag}{i}w{j}" for j in range(width)) for i in range(n)]


def test_planted_runs(spark):
    passage = lines(12, "p")                       # 72 words in short lines
    rows = {1: lines(5, "a") + passage + lines(4, "b"), 2: lines(3, "c") + passage, 3: passage + lines(2, "d"),
            4: lines(7, "e") + ["", "  "] + passage[:9] + ["x y"], 5: lines(2, "f") + passage[3:4] + lines(2, "g")}
    docs = spark.createDataFrame([(k, "\n".join(v)) for k, v in rows.items()], "doc_id long, text string")
    got = texts(L.dedup_lines(docs))
    assert got[1] == "\n".join(rows[1])
    assert got[2] == "\n".join(lines(3, "c")) and got[3] == "\n".join(lines(2, "d"))
    assert got[4] == "\n".join(lines(7, "e") + ["", "  ", "x y"])
    assert got[5] == "\n".join(rows[5])            # one 6-word line is noise
    assert [r.n_removed for r in L.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 12, 12, 9, 0]


def test_inside_one_document(spark):
    text = "\n".join(["same line of six words here"] * 30)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert len(solid(texts(L.dedup_lines(docs))[1])) == 2     # the first gram stays


def test_long_run_beyond_reach(spark):
    passage = lines(300, "p", 4)
    docs = spark.createDataFrame([(1, "\n".join(passage)), (2, "\n".join(["new start"] + passage + ["new end"]))],
                                 "doc_id long, text string")
    assert texts(L.dedup_lines(docs))[2] == "new start\nnew end"


def test_odd_tables(spark):
    long_line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long_line, "k"), (1, long_line, "k"), (2, None, None), (None, long_line, "z"), (4, "", ""), (5, " \n\t\n", ""),
            (6, long_line + "\n\nnew words", "q"), (None, "alone", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed string")
    out = L.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_removed", "n_removed_"]
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.text, r.n_removed_) for r in out.where("text is not null").collect())
    assert got == sorted([((False, 1), long_line, 0), ((False, 1), long_line, 0), ((True, 0), "", 1), ((False, 4), "", 0),
                          ((False, 5), " \n\t\n", 0), ((False, 6), "\nnew words", 1), ((True, 0), "alone", 0)])
    assert out.where("text is null").count() == 1
    assert L.dedup_lines(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = L.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def words(n, tag):
    return [f"{tag}{i}" for i in range(n)]


def brute_passages(rows, noise=L.NOISE_WORDS, run=L.NOISE_WORDS + L.WINDOW_WORDS):
    """{doc_id: kept words}: every word goes that lies in a run of whole lines with
    ``noise`` words, or in a run of ``run`` words, that occurs earlier."""
    first, ranges = {}, {}
    for doc in sorted(rows):
        lines = [x.split() for x in solid(rows[doc])]
        flat, starts = [w for x in lines for w in x], [0]
        for x in lines:
            starts.append(starts[-1] + len(x))
        grams = [(p, p + run - 1, tuple(flat[p:p + run])) for p in range(len(flat) - run + 1)]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if starts[b + 1] - starts[a] >= noise:
                    grams.append((starts[a], starts[b + 1] - 1, tuple(map(tuple, lines[a:b + 1]))))
                    if starts[b] - starts[a] >= 3 * noise:
                        break
        gone = set()
        for lo, hi, gram in sorted(grams, key=lambda g: g[:2]):
            at = first.setdefault(gram, (doc, lo))
            if at != (doc, lo):
                gone.update(range(max(lo, at[1] + hi - lo + 1) if at[0] == doc else lo, hi + 1))
        ranges[doc] = [w for i, w in enumerate(flat) if i not in gone]
    return ranges


def test_passages_inside_lines(spark):
    random = __import__("random").Random(7)
    rows, passages = {}, [words(n, f"p{k}_") for k, n in enumerate((50, 55, 70, 49, 120))]
    for doc in range(60):
        text = []
        for k in random.sample(range(5), 2):
            text += words(random.randrange(3, 40), f"d{doc}a{k}_") + passages[k]
        text += words(random.randrange(0, 9), f"d{doc}z")
        # broken into lines at places of the document's own, some blank
        rows[doc] = "".join(w + random.choice([" "] * 30 + ["  ", "\n", " \n\n"]) for w in text)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = texts(L.dedup_passages(docs))
    want = brute_passages(rows)
    assert {d: t.split() for d, t in got.items()} == want
    joined = " ".join(" ".join(want[d]) + f" |{d}|" for d in sorted(want))
    for k in (0, 1, 2, 4):
        assert joined.count(" ".join(passages[k])) == 1
    whole = texts(L.dedup_lines(docs))      # what whole lines alone leave
    assert sum(len(t.split()) for t in whole.values()) > 2 * sum(len(t.split()) for t in got.values())


def test_passages_keep_the_rest(spark):
    p = " ".join(words(60, "p"))
    rows = {1: f"a b {p} c d", 2: f"e f\n  g h {p} i j  \nk", 3: f"l\n\n{p}\n\nm n ", 4: f"o {p}\nq", 5: f"r\n{p} s",
            6: "t " + p.replace("p30 ", "p30\n") + " u", 7: p, 8: f"v\n{p}\n", 9: "p1 p2 p3"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    out = L.dedup_passages(docs)
    assert texts(out) == {1: rows[1], 2: "e f\n  g h i j  \nk", 3: "l\n\n\nm n ", 4: "o\nq", 5: "r\ns", 6: "t\nu", 7: "",
                          8: "v\n", 9: "p1 p2 p3"}
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2, 7: 1, 8: 1, 9: 0}


def test_passages_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = L.dedup_passages(docs)
    assert {d: (t or "").split() for d, t in texts(out).items()} == {
        d: [w for w in kept] for d, kept in brute_passages({d: t or "" for d, t in texts(docs).items()}).items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_part_of_a_passage_stands_earlier(spark):
    """B and C share six lines; an earlier A has some of them.  Every hash differs
    from trial to trial, and every trial loses the whole passage in C."""
    rows, n = {}, 0
    for trial in range(400):
        passage = lines(6, f"t{trial}p", 10)
        inside = passage[2:3] if trial % 2 else passage[1:4]
        for text in (lines(2, f"t{trial}a") + inside, passage + lines(2, f"t{trial}b"), lines(2, f"t{trial}c") + passage):
            rows[n] = text
            n += 1
    docs = spark.createDataFrame([(k, "\n".join(v)) for k, v in rows.items()], "doc_id long, text string")
    for got in (texts(L.dedup_lines(docs)), texts(L.dedup_passages(docs))):
        assert [got[k] for k in range(2, n, 3)] == ["\n".join(rows[k][:2]) for k in range(2, n, 3)]


def test_every_repeated_line_above_noise_goes(spark):
    """Repeated lines of 8 words and more go whatever stands next to them."""
    rows = {0: [" ".join(f"k{k}w{j}" for j in range(8 + k % 12)) for k in range(200)]}
    for k in range(200):
        rows[k + 1] = lines(4, f"n{k}", 9) + [rows[0][k]] + lines(4, f"m{k}", 9)
    docs = spark.createDataFrame([(k, "\n".join(v)) for k, v in rows.items()], "doc_id long, text string")
    got = texts(L.dedup_lines(docs))
    assert all(got[k + 1] == "\n".join(lines(4, f"n{k}", 9) + lines(4, f"m{k}", 9)) for k in range(200))


def test_clashing_helper_names(spark):
    p = " ".join(words(60, "p"))
    names = ["run_id", "run_th", "runs", "doc_id0", "doc_th", "words", "end", "out", "id0", "th", "w", "t", "lo", "hi", "at", "line",
             "_runs", "_run_id", "_doc_0", "_words", "_left", "_end", "n_removed", "g", "context", "nul", "kind"]
    docs = spark.createDataFrame([(1, f"a {p}"), (2, f"b {p} c")], "doc_id long, text string").select(
        "*", *[F.lit(n).alias(n) for n in names])
    out = L.dedup_passages(docs)
    assert out.columns == [*docs.columns, "n_removed_"]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[2].text == "b c" and all(rows[2][n] == n for n in names)


def test_very_long_texts(spark):
    """100,000 words each: repeats with changes, and one word over and over."""
    one = words(100_000, "v")
    two = [w if i % 1000 else f"x{i}" for i, w in enumerate(one)]
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, "same " * 30_000)]
    got = texts(L.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[1] == rows[0][1] and got[2].split() == [f"x{i}" for i in range(0, 100_000, 1000)]
    assert got[3].split() == ["same"] * 50


def test_working_tables_leave_no_shuffle_files(spark):
    def shuffled():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f.name for d in folders for f in Path(d).rglob("shuffle_*")}
    before, setting = shuffled(), spark.conf.get(common.SHUFFLE_CLEANUP, "false")
    table = common.stage(spark, spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    left = shuffled() - before
    assert table.count() == 7
    common.unstage(table)
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == setting
    assert not left


def test_window_grams_are_equal_where_the_words_are(spark):
    """Of hashed words, whatever stands between them; only the words of the window count."""
    rows = {1: "a b c d e f", 2: " x b\tc\n d  e y", 3: "b c d d e f", 4: None, 5: "a b"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    key = docs.select("doc_id", *L._key(F.col("doc_id"), F.col("text")))
    spans = key.where("doc_id <= 3").select(*L.KEY, F.expr("array(named_struct('lo', 0L, 'hi', 0L), named_struct('lo', 1L, 'hi', 3L))").alias("runs"))
    grams = L.window_grams(docs, spans, "doc_id", "text", 3)
    assert "transform(split(" in grams._jdf.queryExecution().optimizedPlan().toString()     # hashed before the windows are cut
    found = {}
    for r in grams.collect():
        window = tuple(rows[r.id0].split()[r.lo:r.lo + 3])
        assert r.hi == r.lo + 2
        found.setdefault((r.g1, r.g2), set()).add(window)
    windows = {tuple(t.split()[i:i + 3]) for t in (rows[1], rows[2], rows[3]) for i in range(4)}
    assert len(found) == len(windows) and all(len(w) == 1 for w in found.values())
