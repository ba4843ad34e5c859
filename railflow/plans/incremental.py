"""Incremental loads: each load (a week, a day) is merged into what is stored.

Tables live in a ``TableSet``: a load adds delta folders with its own rows only and
publishes all of them with one rename; what belongs together is merged on read.

``train_movements`` (E1).  Two loads give what one load of everything gives, in any
order and run any number of times:

* a planned row is identified by its snapshot and stop; of several rows the first by
  archive member (then by the other columns) counts, whichever load brings it.  A
  load adds rows with a new identity to ``planned``; a row that comes before the
  stored one of its identity goes to ``better`` (rare: only contradicting archives
  have any), and the reader prefers it;
* changes are folded per stop and load (``changes``); the reader merges the folds.
  So a change may arrive in a later load than its stop, or an earlier one, and no
  stored stop is rewritten for it.

Star schema (E2).  Dimension keys are stable: known members keep theirs, unseen ones
get the next numbers in natural order.  Of several planned rows of one stop the first
*inserted* wins: within a load the first snapshot, over loads the load that came
first; so loads are to come in snapshot order to equal one load of everything.
Changes are folded and merged on read as above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railflow.operators import star as S
from railflow.operators.fold import fold_state, merge_deltas
from railflow.operators.index import with_dense_key
from railflow.operators.merge import as_unmatched, first_wins, merge_movements, unmatched_changes
from railflow.operators.names import DEFAULT_PREFIX
from railflow.operators.sinks import PARTITION_COLUMNS
from railflow.operators.store import Load, TableSet, together
from railflow.schemas import MOVEMENT_COLUMNS
from railflow.session import ensure_checkpoint_dir

CHANGED = ["changed_arrival_time", "changed_departure_time", "changed_platform",
           "arrival_delay_minutes", "departure_delay_minutes"]
IDENTITY = [*PARTITION_COLUMNS, "stop_id"]
PLANNED = [*IDENTITY, "member", *[c for c in MOVEMENT_COLUMNS if c not in IDENTITY and c not in CHANGED]]
FEW_STOPS = 100_000     # stops whose numbers may be broadcast
FACT_ROWS = [c for c in S.FACT_COLUMNS if c not in CHANGED]


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    names = {c: f"_r_{c}" for c in columns}
    right = right.select(*[F.col(c).alias(n) for c, n in names.items()])
    cond = [left[c].eqNullSafe(right[n]) for c, n in names.items()]
    return left.join(right, cond, how)


# ------------------------------------------------------------ change state

def add_changes(load: Load, changes: DataFrame, policy: str) -> None:
    """The load's fold as a delta; full tiers of deltas are merged."""
    load.append("changes", fold_state(changes, policy))
    load.compact("changes", lambda states: merge_deltas(states, policy))


def change_state(tables: TableSet, policy: str, like: DataFrame | None = None) -> DataFrame | None:
    """One row per stop over all loads."""
    states = tables.read("changes")
    return None if states is None else merge_deltas(states, policy)


def load_changes(changes: DataFrame, path: str, policy: str) -> None:
    """Merge change rows into the change state at ``path``."""
    load = TableSet(changes.sparkSession, path).load()
    add_changes(load, changes, policy)
    load.commit()


def read_change_state(spark: SparkSession, path: str, policy: str) -> DataFrame | None:
    return change_state(TableSet(spark, path), policy)


def _add_unmatched(load: Load, changes: DataFrame, stops: DataFrame) -> None:
    """The load's changes without a stop in ``stops``.  ``add_changes`` has folded them,
    so the stops to look for come from its delta; the changes themselves are only
    shuffled for a join if very many stops are missing."""
    own = load.read("changes", load.deltas("changes")[-1:])     # the load's delta, or the merge that took it in
    missing = own.select("stop_id").join(stops.select("stop_id"), "stop_id", "left_anti").checkpoint()
    if missing.limit(FEW_STOPS + 1).count() <= FEW_STOPS:
        rows = as_unmatched(_null_safe(changes, F.broadcast(missing), ["stop_id"], "left_semi"))
    else:
        rows = unmatched_changes(changes, stops)
    load.append("unmatched", rows.distinct())


def _unmatched(tables: TableSet, stops: DataFrame) -> DataFrame | None:
    """Changes whose stop has not come with any load so far, each once."""
    rows = tables.read("unmatched")
    return None if rows is None else rows.join(stops.select("stop_id"), "stop_id", "left_anti").distinct()


def _quarantine(tables: TableSet) -> DataFrame | None:
    rows = tables.read("quarantine")
    return None if rows is None else rows.distinct()


# ------------------------------------------------------------ train_movements

def _planned(tables: TableSet) -> DataFrame | None:
    """One row per identity over all loads."""
    rows = tables.read("planned")
    if not tables.deltas("better"):
        return rows
    better = tables.read("better")
    return _null_safe(rows, better, IDENTITY, "left_anti").unionByName(first_wins(better, IDENTITY, ["member"]))


def _row(names: list[str], of: str = "") -> Column:
    return F.struct(*[F.col(f"{of}{c}") for c in names])


def load_movements(planned: DataFrame, changes: DataFrame, path: str, policy: str = "max",
                   layout: list[str] = PARTITION_COLUMNS, quarantine: DataFrame | None = None,
                   keep_unmatched: bool = False) -> DataFrame:
    """Merge one load into ``train_movements`` at ``path``; the merged fact.

    ``planned``: planned rows with ``eva_number`` (``pipelines.resolve_planned``);
    ``changes``: change rows; ``layout``: the folder columns of the planned rows."""
    spark = planned.sparkSession
    ensure_checkpoint_dir(spark)
    tables = TableSet(spark, path)
    load = tables.load()
    rows = first_wins(planned.select(*PLANNED), IDENTITY, ["member"])
    stored = _planned(tables)
    if stored is not None:
        # only the folders that the load touches are read: at most its snapshots' values
        values = [r[0] for r in planned.select(layout[0]).distinct().collect()]
        near = F.col(layout[0]).isin([v for v in values if v is not None])
        stored = stored.where(near | F.col(layout[0]).isNull() if None in values else near)
        rest = [c for c in PLANNED if c not in IDENTITY]
        known = stored.select(*[F.col(c).alias(f"_k_{c}") for c in PLANNED], F.lit(True).alias("_known"))
        rows = rows.join(known, [rows[c].eqNullSafe(known[f"_k_{c}"]) for c in IDENTITY], "left").withColumn(
            "_new", F.col("_known").isNull()).withColumn("_better", _row(rest) < _row(rest, "_k_"))
        rows = rows.select(*PLANNED, "_new", "_better").checkpoint()     # two outputs of one join
        load.append("better", rows.where(~F.col("_new") & F.col("_better")).select(*PLANNED))
        rows = rows.where("_new")
    steps = [lambda: load.append("planned", rows.select(*PLANNED).repartitionByRange(*layout, "stop_id"), layout),
             lambda: add_changes(load, changes, policy)]
    if quarantine is not None:
        steps.append(lambda: load.append("quarantine", quarantine.distinct()))
    together(*steps)
    if keep_unmatched:
        _add_unmatched(load, changes, load.read("planned"))
    return movements_of(load.commit(), policy)


def movements_of(tables: TableSet, policy: str = "max") -> DataFrame:
    rows, state = _planned(tables), change_state(tables, policy)
    if rows is None:
        raise ValueError(f"no movements at {tables.root}")
    if state is None:
        state = rows.select("stop_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("changed_arrival_time", "timestamp_ntz"), ("changed_departure_time", "timestamp_ntz"),
            ("changed_platform", "string"), ("cancelled", "boolean"))]).limit(0)
    return merge_movements(rows, state)


def read_movements(spark: SparkSession, path: str, policy: str = "max") -> dict[str, DataFrame | None]:
    """What is stored at ``path``: the fact, the malformed documents and the changes
    without a planned stop (None: there never were any)."""
    tables = TableSet(spark, path)
    rows = movements_of(tables, policy)
    return {"train_movements": rows, "quarantine": _quarantine(tables), "unmatched": _unmatched(tables, rows)}


# ------------------------------------------------------------ star schema

def unseen_members(stored: DataFrame | None, members: DataFrame, order: list[str], key: str) -> DataFrame:
    """The members that ``stored`` lacks, numbered on from its largest key in
    natural order."""
    if stored is None:
        return with_dense_key(members, order, key)
    unseen = _null_safe(members, stored, members.columns, "left_anti")
    top = stored.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))       # one row
    added = with_dense_key(unseen, order, key).join(F.broadcast(top)).withColumn(key, F.col(key) + F.col("_top"))
    return added.select(*stored.columns)


def _trips(planned: DataFrame, trip_start_col: Column | None) -> tuple[DataFrame, Column]:
    from railflow.functions.timefmt import trip_start
    start = trip_start_col if trip_start_col is not None else trip_start("stop_id")
    return planned.withColumn("trip_start", start), start


def dimension_steps(load: Load, members: dict[str, tuple]) -> list:
    """Steps that add unseen members (name -> members, natural order, key) to the
    dimensions."""
    def step(name, rows, order, key):
        return lambda: load.append(name, unseen_members(load.read(name), rows, order, key))
    return [step(name, *spec) for name, spec in members.items()]


def calendar_members(trips: DataFrame) -> dict[str, tuple]:
    return {"dim_date": (S.dates_of(trips), ["date"], "date_id"), "dim_time": (S.times_of(trips), ["time"], "time_id")}


def load_calendar(planned: DataFrame, out_dir: str, trip_start_col: Column | None = None) -> dict[str, DataFrame]:
    """A load of the date and time dimensions alone."""
    load = TableSet(planned.sparkSession, out_dir).load()
    together(*dimension_steps(load, calendar_members(_trips(planned, trip_start_col)[0])))
    tables = load.commit()
    return {name: tables.read(name) for name in ("dim_date", "dim_time")}


def load_star(planned: DataFrame, changes: DataFrame, stations: DataFrame, out_dir: str,
              prefix: str = DEFAULT_PREFIX, trip_start_col: Column | None = None,
              quarantine: DataFrame | None = None) -> dict[str, DataFrame]:
    """Merge one load into the star schema under ``out_dir``; its tables."""
    ensure_checkpoint_dir(planned.sparkSession)
    load = TableSet(planned.sparkSession, out_dir).load()
    trips, start = _trips(planned, trip_start_col)
    members = {"dim_station": (stations, ["eva_number", "name"], "station_id"),
               "dim_train": (planned.select(*S.TRAIN_KEY).distinct(), S.TRAIN_KEY, "train_id"), **calendar_members(trips)}
    steps = [*dimension_steps(load, members), lambda: add_changes(load, changes, "last")]
    if quarantine is not None:
        steps.append(lambda: load.append("quarantine", quarantine.distinct()))
    together(*steps)
    dims = {name: load.read(name) for name in members}
    # the parts of the snapshot's time follow from it: they settle no tie and are in no fact
    first = first_wins(planned.drop(*PARTITION_COLUMNS), ["stop_id"], ["snapshot_ts", "member"], existing=load.read("fact_rows"))
    rows = S.with_foreign_keys(first.withColumn("trip_start", start), dims["dim_station"], dims["dim_train"],
                               dims["dim_date"], dims["dim_time"], prefix)
    load.append("fact_rows", rows.select(*FACT_ROWS))
    _add_unmatched(load, changes, load.read("fact_rows"))      # all stops of this load and earlier ones
    return star_of(load.commit())


def star_of(tables: TableSet) -> dict[str, DataFrame]:
    """The star schema's tables, deltas merged; tables that never had rows are left out."""
    out = {name: tables.read(name) for name in ("dim_station", "dim_train", "dim_date", "dim_time")}
    rows, state = tables.read("fact_rows"), change_state(tables, "last")
    if rows is not None:
        if state is None:
            out["fact_train_movements"] = rows.select(*[F.col(c) if c in FACT_ROWS else F.lit(None).cast(
                {"changed_platform": "string"}.get(c, "int" if c.endswith("minutes") else "timestamp_ntz")).alias(c)
                for c in S.FACT_COLUMNS])
        else:
            out["fact_train_movements"] = S.apply_folded(rows, state).select(*S.FACT_COLUMNS)
        out["unmatched_timetable_changes"] = _unmatched(tables, rows)
    out["quarantine"] = _quarantine(tables)
    return {name: table for name, table in out.items() if table is not None}


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return star_of(TableSet(spark, out_dir))
