"""Operator 6, mixing sources to target weights: hierarchical budgeting.

The corpus is a tree domain -> language -> source.  A node's capacity is what its
leaves can give: tokens times the epochs allowed.  The token budget is handed down
level by level in proportion to integer weights.  A child that cannot use its share
gets its capacity, and its shortage goes to its siblings; since a parent never
gets more than its own capacity, only what all siblings together cannot use
reaches the parent's siblings.  The level at which a parent's children fill up has
a closed form over children sorted by capacity per weight, so each level is one
window over the small table of nodes, in exact integers.

Every leaf passes through its documents in seeded epochs, each in its own random
order: whole epochs first, then the prefix of the next one whose documents start
inside the remaining budget.

Everything is DataFrame code.  A leaf may hold a third of all rows; its prefix sums
are taken over sqrt(n) ordered buckets (``ranking.running_start``).

Defined results: tokens are words; a null or blank text has none and is taken when
its place in the order lies inside the budget; null languages and sources are
nodes of their own; repeated rows are taken one by one; a weight of 0 takes a node
out; a budget above all capacity takes everything; an empty table gives no rows;
extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railflow.llm.common import HASH60, SPACE_CHARS, WORD_GAP, fresh, hash60, sqrt_buckets, stage, unstage
from railflow.llm.ranking import running_start

SEED = 29
LEVELS = ["domain", "lang", "source"]
MAX_EPOCHS = 2
BUDGET = (3, 5)      # of the corpus' tokens
# Integer weight of a node among its siblings; unlisted nodes weigh 1.
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}


def domain_of(source: Column) -> Column:
    """Domain of a source where the corpus names none: one of four by hash."""
    return F.concat(F.lit("domain"), (hash60(F.lit("domain"), source) % 4).cast("string"))


def word_tokens(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, WORD_GAP))).cast("long")


def _name(column: Column) -> Column:
    """Node name that is never null."""
    return F.when(column.isNull(), "null").otherwise(F.concat(F.lit("="), column.cast("string")))


def _weight(column: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():
        out = F.when(column == "=" + name, weight).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parent: list[str], child: str, budget: str, out: str) -> DataFrame:
    """Split each parent's ``budget`` among its children by weight, at most
    ``capacity`` each; whatever one cannot use goes to its siblings."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = F.col("capacity").cast("double") / F.col("weight").cast("double")
    order = by.orderBy(F.when(F.col("weight") > 0, ratio).otherwise(-1.0), child)
    usable = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)
    nodes = nodes.withColumn("_capacity", usable)
    nodes = nodes.withColumns({
        "_before": F.sum("_capacity").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_capacity"),
        "_from": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    # full if filling all children up to this one's level stays inside the budget
    full = (F.col(budget) - F.col("_before")) * F.col("weight") >= F.col("_capacity") * F.col("_from")
    nodes = nodes.withColumn("_full", full | (F.col("weight") == 0))
    nodes = nodes.withColumns({
        "_left": F.col(budget) - F.sum(F.when(F.col("_full"), F.col("_capacity")).otherwise(0)).over(by),
        "_open": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(by)})
    part = F.expr("_left * weight div greatest(_open, 1)")
    return nodes.withColumn(out, F.when(F.col("_full"), F.col("_capacity")).otherwise(part)).drop(
        "_capacity", "_before", "_from", "_full", "_left", "_open")


def leaf_budgets(leaves: DataFrame, budget: tuple[int, int], max_epochs: int,
                 weights: dict[str, dict[str, int]]) -> DataFrame:
    """(domain, lang, source, tokens, target) per leaf; names as by ``_name``."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all")).select(
        F.least(F.expr(f"`all` * {budget[0]} div {budget[1]}"), F.col("all") * max_epochs).alias("given"))
    given = total.select(F.col("given").alias("budget"))
    shared = given.select("budget", F.lit(0).alias("_one"))
    for depth, level in enumerate(LEVELS):
        path = LEVELS[:depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn(
            "weight", _weight(F.col(level), weights.get(level, {})))
        above = shared if depth == 0 else shared.select(*LEVELS[:depth], F.col("given").alias("budget"))
        nodes = nodes.withColumn("_one", F.lit(0)).join(above, "_one").drop("_one") if depth == 0 else nodes.join(
            above, LEVELS[:depth])
        shared = share_out(nodes, LEVELS[:depth], level, "budget", "given")
    return shared.select(*LEVELS, F.col("given").alias("target"))


def mix(docs: DataFrame, domain: Column | None = None, budget: tuple[int, int] = BUDGET,
        max_epochs: int = MAX_EPOCHS, weights: dict[str, dict[str, int]] = WEIGHTS, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
        tokens_col: str = "n_tokens", epoch_col: str = "epoch", domain_col: str = "domain") -> DataFrame:
    """The mixture: every selected row once per epoch in which it is taken,
    with all its columns, its domain, tokens and epoch (0-based)."""
    tokens_col, epoch_col, domain_col = (fresh(docs, c) for c in (tokens_col, epoch_col, domain_col))
    domain = domain_of(F.col(source_col)) if domain is None else domain
    rows = docs.withColumns({tokens_col: word_tokens(F.col(text_col)), domain_col: domain})
    keys = [fresh(rows, c) for c in ("domain_key", "lang_key", "source_key")]
    rows = rows.withColumns(dict(zip(keys, [_name(F.col(domain_col)), _name(F.col(lang_col)), _name(F.col(source_col))])))
    epochs, rest, order, start = (fresh(rows, c) for c in ("epochs", "rest", "order", "start"))
    leaves = stage(docs.sparkSession, rows.groupBy(*[F.col(k).alias(level) for k, level in zip(keys, LEVELS)]).agg(
        F.sum(tokens_col).alias("tokens"), F.count("*").alias("n_rows")), "mixing-leaves")     # one row per leaf
    targets = leaf_budgets(leaves.drop("n_rows"), budget, max_epochs, weights).join(leaves, LEVELS).select(
        *[F.col(level).alias(k) for k, level in zip(keys, LEVELS)],
        F.expr("target div greatest(tokens, 1)").cast("int").alias(epochs),
        F.expr("target % greatest(tokens, 1)").alias(rest))
    targets = stage(docs.sparkSession, targets, "mixing-targets")
    n_rows = leaves.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    unstage(leaves)
    rows = rows.join(targets, keys)
    rows = rows.withColumn(order, hash60(F.lit(seed), F.col(epochs), F.col(id_col)))
    rows = running_start(rows, keys, F.expr(f"`{order}` div {-(-HASH60 // sqrt_buckets(n_rows))}L"),
                         [F.col(order), F.col(id_col), F.col(tokens_col)], F.col(tokens_col), start)
    times = F.col(epochs) + F.when(F.col(start) < F.col(rest), 1).otherwise(0)
    rows = rows.where(times > 0).withColumn(epoch_col, F.explode(F.sequence(F.lit(0), times - 1)))
    return rows.drop(*keys, epochs, rest, order, start)
