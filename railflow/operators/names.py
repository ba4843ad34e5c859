"""Loose station-name resolution.

A raw name is tried in four spellings, first *present* wins:
exact; without the city prefix (``^<prefix>([- ]?)``); ``<prefix>-<raw>``;
``<prefix> <raw>``; else NULL.

Distributed form: the rule is inverted on the (small) station side.  For
every station name the raw spellings that resolve to it are generated with
their priority, and the best station per raw spelling is kept (a few rows
per station).  The input is then joined once on its raw name: one pass over
the big side, which is never grouped, deduplicated or read twice.  Spark
(and AQE at run time) broadcasts the inverted table when it is small and
sort-merge joins it (with skew splitting) when it is not.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the reference city prefix of the station names.
DEFAULT_PREFIX = "Berlin"


def candidate_names(raw, prefix: str = DEFAULT_PREFIX):
    """The four spellings in priority order (an array Column)."""
    stripped = F.regexp_replace(raw, f"^{re.escape(prefix)}([- ]?)", "")
    return F.array(raw, stripped, F.concat(F.lit(f"{prefix}-"), raw), F.concat(F.lit(f"{prefix} "), raw))


def lookup_table(stations: DataFrame, name_col: str = "name", id_col: str = "eva_number",
                 order_col: str | None = None) -> DataFrame:
    """name -> id, one row per name.  Of a repeated name the last row in ``order_col``
    counts; without an order the largest id, so the choice does not depend on read
    order."""
    best = F.max_by(id_col, order_col) if order_col else F.max(id_col)
    return (stations.filter(F.col(name_col).isNotNull())
            .groupBy(F.col(name_col).alias("_name")).agg(best.alias("_id")))


def inverted_lookup(lookup: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """``(_raw, _id)``: every raw spelling that resolves to a station of
    ``lookup`` (``_name, _id``), with the station it resolves to.

    For a station name N the spellings are, by priority:
    0  N itself;
    1  prefix + sep + N (the strip rule), sep in {"-", " "}, and sep = ""
       unless N starts with "-" or " " (the optional separator would be
       taken from N);
    2  N without a leading prefix + "-" (the "add prefix-" rule);
    3  N without a leading prefix + " " (the "add prefix " rule).
    A raw spelling reaching several stations keeps the lowest priority."""
    n = F.col("_name")
    tail = F.substr(n, F.lit(len(prefix) + 2))
    glued_ok = ~(n.startswith("-") | n.startswith(" "))
    spellings = F.array(
        F.struct(F.lit(0).alias("rank"), n.alias("raw")),
        F.struct(F.lit(1).alias("rank"), F.concat(F.lit(f"{prefix}-"), n).alias("raw")),
        F.struct(F.lit(1).alias("rank"), F.concat(F.lit(f"{prefix} "), n).alias("raw")),
        F.struct(F.lit(1).alias("rank"), F.when(glued_ok, F.concat(F.lit(prefix), n)).alias("raw")),
        F.struct(F.lit(2).alias("rank"), F.when(n.startswith(f"{prefix}-"), tail).alias("raw")),
        F.struct(F.lit(3).alias("rank"), F.when(n.startswith(f"{prefix} "), tail).alias("raw")),
    )
    pairs = lookup.select("_id", F.explode(spellings).alias("s")).filter(F.col("s.raw").isNotNull())
    return pairs.groupBy(F.col("s.raw").alias("_raw")).agg(F.min_by("_id", F.col("s.rank")).alias("_id"))


def resolve_names(df: DataFrame, raw_col: str, lookup: DataFrame,
                  prefix: str = DEFAULT_PREFIX, out_col: str = "resolved_id") -> DataFrame:
    """Add ``out_col`` = id of the first present spelling of ``raw_col``."""
    inv = inverted_lookup(lookup, prefix)
    joined = df.join(inv, df[raw_col] == inv["_raw"], "left")
    return joined.select(*[df[c] for c in df.columns], F.col("_id").alias(out_col))
