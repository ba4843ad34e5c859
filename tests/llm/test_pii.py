"""Personal data: base spans by plain patterns, discovery in planted contexts."""

import hashlib
import re

from railflow.llm import pii

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [None, "", "   ", "a@b.c_d@e.f x@y z@q.r-s.t..u", "1.2.3.4.5.6.7.8.9 300.1.1.1 0001.02.3.255",
        "4111 1111 1111 1111 and 4111-1111-1111-1112, 5", "+1 (017) 555-7713 +44 20 7946 0958) +12", "é😀 a@b.cd 😀 1.1.1.1",
        "a" * 30_000, "1" * 30_000, "1 " * 20_000, "a@" * 5000 + "b.c", "1.1.1.1 " * 300, "@@ + ++1 +1-", "x%y@a.b.+c@d.e",
        "a-" * 20_000, "0" * 12, "4111111111111111.7.8.9 +4111111111111111", "\n1.2.\n3.4 a@b\n.c"]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def check(rows, got, extra=True):
    for text, r in zip(rows, got):
        want = brute(text)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in PLAIN], text and text[:80]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), text and text[:80]
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
        assert extra or r.spans == line


def test_hard_texts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(HARD)], "doc_id long, text string, spans string")
    got = pii.find_personal_data(docs).orderBy("doc_id").collect()
    assert len(got) == len(HARD)
    check(HARD, got, extra=False)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = pii.find_personal_data(docs).orderBy("doc_id").collect()
    assert len(got) == len(rows)
    check([rows[r.doc_id] for r in got], got)


def test_context_finds_unseen_identifiers(spark):
    texts = [f"please ring me at +1 (2{i:02}) 555-{1000 + i} any day" for i in range(12)]
    texts += ["please ring me at 243-555-5526 any day.", "serial 243-555-9999 of the box", "ring 99887766 x",
              "write to someone(at)example.com now", "see the number 12345678 of the list"]
    texts += [f"write to user{i}@example.com now" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    assert got[12] == "phone:18:30" and got[15] == "email:9:31"
    assert got[13] == got[14] == got[16] == ""


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a@b.cd"), (1, "a@b.cd"), (1, "a@b.cd")], "doc_id long, text string")
    assert [r.spans for r in pii.find_personal_data(docs).collect()] == ["email:0:6"] * 3
    assert pii.find_personal_data(docs.limit(0)).collect() == []
