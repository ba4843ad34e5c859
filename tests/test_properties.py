
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railflow.functions import split_stop_id
from railflow.operators import graph as G
from railflow.sources import analogs as A

SF = "/root/testdata/sf0.001"


def test_bfs_levels_respect_every_edge(spark):
    # hops(v) <= hops(u) + 1 for every edge u -> v between reached stations,
    # and every path is a walk along edges of its own length
    edges = G.trip_edges(A.hop_movements(spark, SF))
    paths = G.shortest_paths(edges, "0")
    h = paths.select("station_name", "hops")
    bad = (edges.join(h.withColumnRenamed("station_name", "src").withColumnRenamed("hops", "hu"), "src")
           .join(h.withColumnRenamed("station_name", "dst").withColumnRenamed("hops", "hv"), "dst")
           .filter(F.col("hv") > F.col("hu") + 1))
    assert bad.count() == 0
    steps = paths.filter(F.col("hops") > 0).select(
        "hops", F.posexplode(F.arrays_zip(F.slice("path", 1, F.col("hops")),
                                          F.slice("path", 2, F.col("hops")))).alias("i", "step"))
    assert steps.filter(F.col("i") >= F.col("hops")).count() == 0
    hop = steps.select(F.col("step.0").alias("src"), F.col("step.1").alias("dst"))
    assert hop.join(edges, ["src", "dst"], "left_anti").count() == 0


_ID = st.builds(lambda sign, trip, stamp, idx: f"{sign}{trip}-{stamp}-{idx}",
                st.sampled_from(["", "-"]), st.integers(0, 10**12), st.integers(10**9, 10**10 - 1),
                st.integers(0, 999))
_JUNK = st.text(alphabet="-0123456789ab", max_size=12)


@settings(max_examples=5, deadline=None)
@given(ids=st.lists(st.one_of(_ID, _JUNK), min_size=1, max_size=200))
def test_split_stop_id_matches_rsplit(spark, ids):
    got = spark.createDataFrame([(i,) for i in ids], "stop_id string").select(
        "stop_id", *split_stop_id("stop_id")).collect()
    for r in got:
        m = re.fullmatch(r"(.*)-(\d+)", r.stop_id, flags=re.S)
        if m and m.group(1):
            assert (r.trip_key, r.stop_index) == (m.group(1), int(m.group(2)))
        else:
            assert r.stop_index is None or r.trip_key is None


def _forward(raw, lookup, prefix):
    # the rule stated directly: first present of four spellings
    cands = [raw, re.sub("^" + re.escape(prefix) + "([- ]?)", "", raw), f"{prefix}-{raw}", f"{prefix} {raw}"]
    for c in cands:
        if c in lookup:
            return lookup[c]
    return None


_PIECE = st.sampled_from(["B", "-", " ", "x", "Bx", "B-", "B "])
_NAME = st.lists(_PIECE, min_size=0, max_size=4).map("".join)


@settings(max_examples=8, deadline=None)
@given(names=st.lists(_NAME, min_size=1, max_size=12, unique=True), raws=st.lists(_NAME, min_size=1, max_size=30))
def test_inverted_lookup_equals_forward_rule(spark, names, raws):
    from railflow.operators.names import lookup_table, resolve_names
    stations = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, eva_number int")
    lookup = {n: i for i, n in enumerate(names)}
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "k int, raw string")
    got = {r.k: r.resolved_id for r in resolve_names(df, "raw", lookup_table(stations), "B").collect()}
    want = {i: _forward(r, lookup, "B") for i, r in enumerate(raws)}
    assert got == want
