"""Operator 8, URL filters: a blocked Bloom filter before an exact hash join.

The listed URLs are made canonical and hashed; each hash sets a few bits in one
256-bit block.  The blocks are one bit-OR aggregate, at most ``MAX_BLOCKS`` rows
of 40 bytes whatever the list's length, so they may be broadcast.  A URL whose
bits are all set is a possible hit; only possible hits reach the exact join
with the list, which removes the false positives.  A list too long for the
bounded filter only sends more URLs to the exact join.

Host and path rules are applied first; the longest fitting rule wins.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and is never listed; repeated URLs are judged each; an empty list
blocks nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 16      # 2.6 MB of broadcast rows at most
BITS_PER_URL = 16
PROBES = 6                # bits set in the block of a URL

# Fixed rules of the query: (host, path prefix, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) text after the first ``://`` up to / ? # or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Spelling variants of one page fall together: ``www.`` and ``m.`` hosts,
    a trailing ``.html`` or slash, scheme, query and fragment do not count.
    Null where there is no host."""
    plain_host = F.regexp_replace(host, r"^(www|m)\.(?=[^.]+\.)", "")
    plain_path = F.regexp_replace(path, r"(\.html|/)$", "")
    return F.when(host != "", F.concat(plain_host, plain_path))


def with_parts(df: DataFrame, url: str) -> DataFrame:
    df = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    return df.withColumn("canonical_url", canonical(F.col("host"), F.col("path")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls.  Longest is
    the rule's whole text; equal lengths: the first listed."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, prefix, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        text = F.when(fits, rule_host + prefix).otherwise(text)
        verdict = F.when(fits, says).otherwise(verdict)
    return text, verdict


def _bits(url: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the four 64-bit words of a URL's mask."""
    h = F.xxhash64(url)
    block = F.pmod(h, F.lit(n_blocks)).cast("int")
    probes = F.xxhash64(url, F.lit(1))
    words = []
    for w in range(4):
        word = F.lit(0).cast("long")
        for k in range(PROBES):
            bit = F.shiftrightunsigned(probes, 8 * k).bitwiseAND(F.lit(255).cast("long"))
            one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63).cast("long")).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftrightunsigned(bit, 6) == w, one).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return block, words


def bloom_blocks(listed: DataFrame, url: str, n_blocks: int) -> DataFrame:
    """The filter: one row (block, w0..w3) per block that has a bit set."""
    block, words = _bits(F.col(url), n_blocks)
    keys = listed.select(block.alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
    return keys.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def block_count(n_urls: int) -> int:
    need = max(1, n_urls) * BITS_PER_URL / 256
    return min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(need))))


def with_listed(pages: DataFrame, listed: DataFrame, url: str, n_listed: int | None = None) -> DataFrame:
    """Add ``maybe_listed`` (the filter's answer) and ``listed`` (exact).

    ``listed`` has one canonical URL per row in column ``url`` (repeats and
    nulls allowed); ``pages`` has the canonical URL in the same column.
    """
    listed = listed.select(url).where(F.col(url).isNotNull()).distinct()
    n_blocks = block_count(listed.count() if n_listed is None else n_listed)
    blocks = bloom_blocks(listed, url, n_blocks)
    block, words = _bits(F.col(url), n_blocks)
    probed = pages.withColumns({"_block": F.when(F.col(url).isNotNull(), block),
                                **{f"_m{i}": w for i, w in enumerate(words)}})
    probed = probed.join(F.broadcast(blocks), F.col("_block") == F.col("block"), "left")
    hit = F.lit(True)
    for i in range(4):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"_m{i}")) == F.col(f"_m{i}"))
    probed = probed.withColumn("maybe_listed", F.coalesce(hit, F.lit(False))).drop(
        "_block", "block", *[f"_m{i}" for i in range(4)], *[f"w{i}" for i in range(4)])
    # only possible hits carry a join key: the rest is not sent through the exact join
    key = F.when(F.col("maybe_listed"), F.col(url))
    exact = listed.select(F.col(url).alias("_listed_url"))
    hits = probed.where("maybe_listed").withColumn("_key", key).join(
        exact, F.col("_key") == F.col("_listed_url"), "left").withColumn(
        "listed", F.col("_listed_url").isNotNull()).drop("_key", "_listed_url")
    return hits.unionByName(probed.where("NOT maybe_listed").withColumn("listed", F.lit(False)))


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Verdict per page: the rule's, else block if listed, else allow.
    ``listed`` holds URLs in column ``url``."""
    parts = with_parts(pages.select(id_col, F.col(url_col).alias("url")), "url").drop("url")
    names = with_parts(listed.select("url"), "url").select("canonical_url")
    found = with_listed(parts, names, "canonical_url")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    return found.select(
        id_col, "host", "path", rule.alias("rule"),
        F.coalesce(says, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "canonical_url", "listed")
