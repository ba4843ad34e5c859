"""Loads one after the other equal one load of everything."""

import pytest
from pyspark.sql import functions as F

from railflow.operators import fold, merge, store
from railflow.plans import incremental
from railflow.plans.incremental import load_changes, load_movements, load_star, read_change_state, read_movements, read_star
from railflow.plans.pipelines import etl_movements, etl_star, resolve_planned
from tests.handfixture import write_tar

WEEK1 = {"2509020700/Berlin Ostkreuz/t.xml": '<timetable station="Berlin Ostkreuz">'
         '<s id="1-2509020700-1"><tl f="N" t="p" o="800" c="S" n="1"/><dp pt="2509020700" pp="1" ppth="A|B"/></s></timetable>',
         "2509090000/Berlin Ostkreuz/t.xml": '<timetable station="Berlin Ostkreuz">'
         '<s id="2-2509090000-1"><tl f="N" t="p" o="800" c="S" n="2"/><dp pt="2509090000" pp="1" ppth="A|B"/></s></timetable>',
         "2509090000/Berlin Ostkreuz/broken.xml": "<timetable"}
WEEK2 = {"2509090000/Berlin-Wedding/t.xml": '<timetable station="Berlin-Wedding">'
         '<s id="3-2509090000-1"><tl f="N" t="p" o="800" c="S" n="3"/><dp pt="2509090010" pp="2" ppth="A|C"/></s></timetable>',
         "2509100000/Berlin-Wedding/t.xml": '<timetable station="Berlin-Wedding">'
         '<s id="4-2509100000-1"><tl f="N" t="p" o="800" c="S" n="1"/><dp pt="2509100000" pp="2" ppth="A|C"/></s></timetable>'}
CHANGES1 = {"2509020715/Berlin Ostkreuz/c.xml": '<timetable station="Berlin Ostkreuz" eva="2">'
            '<s id="1-2509020700-1"><dp ct="2509020705"/></s><s id="4-2509100000-1"><dp ct="2509100001"/></s></timetable>'}
CHANGES2 = {"2509090015/Berlin Ostkreuz/c.xml": '<timetable station="Berlin Ostkreuz" eva="2">'
            '<s id="2-2509090000-1"><dp ct="2509090020"/></s><s id="9-2509090000-1"><dp ct="2509090020"/></s></timetable>'}


def _weeks(folder):
    for name, docs in (("p1", WEEK1), ("p2", WEEK2), ("c1", CHANGES1), ("c2", CHANGES2)):
        write_tar(f"{folder}/{name}.tar.gz", docs)
    path = lambda *names: [f"{folder}/{n}.tar.gz" for n in names]
    return path


def _same(one, two):
    columns = sorted(one.columns)
    assert columns == sorted(two.columns)
    one, two = one.select(*columns), two.select(*columns)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_boundary_day_and_late_changes_of_movements(spark, rail, tmp_path):
    path, st = _weeks(tmp_path), str(rail.root / "station_data.json")
    etl_movements(spark, path("p1"), path("c1"), st, f"{tmp_path}/week")
    etl_movements(spark, path("p2"), path("c2"), st, f"{tmp_path}/week")
    got = etl_movements(spark, path("p2"), path("c2"), st, f"{tmp_path}/week")      # once more changes nothing
    whole = etl_movements(spark, path("p1", "p2"), path("c1", "c2"), st, f"{tmp_path}/whole")
    delays = {r.stop_id[0]: r.departure_delay_minutes for r in got.collect()}
    assert delays == {"1": 5, "2": 20, "3": None, "4": 1}
    _same(got, whole)
    for part in ("quarantine", "unmatched"):
        one, two = (read_movements(spark, f"{tmp_path}/{n}")[part] for n in ("week", "whole"))
        assert one.count() == two.count() == 1


def test_star_by_week(spark, rail, tmp_path):
    path, st = _weeks(tmp_path), str(rail.root / "station_data.json")
    first = etl_star(spark, path("p1"), path("c1"), st, f"{tmp_path}/week")
    before = {t: {tuple(r) for r in first[t].collect()} for t in ("dim_date", "dim_time", "dim_train", "dim_station")}
    for _ in range(2):
        got = etl_star(spark, path("p2"), path("c2"), st, f"{tmp_path}/week")
    whole = etl_star(spark, path("p1", "p2"), path("c1", "c2"), st, f"{tmp_path}/whole")
    for name, rows in before.items():
        now = {tuple(r) for r in got[name].collect()}
        assert rows <= now and sorted(r[0] for r in now) == list(range(1, len(now) + 1))

    def natural(t):
        fact = t["fact_train_movements"]
        for dim, key in (("dim_train", "train_id"), ("dim_date", "date_id"), ("dim_time", "time_id"), ("dim_station", "station_id")):
            keep = ["station_id", "name"] if dim == "dim_station" else t[dim].columns
            fact = fact.join(t[dim].select(*keep), key, "left").drop(key)
        return fact
    _same(natural(got), natural(whole))
    _same(got["unmatched_timetable_changes"], whole["unmatched_timetable_changes"])


def test_loads_of_the_fixture_in_two_parts(spark, rail, tmp_path):
    planned = resolve_planned(rail.planned, rail.stations)
    late = F.col("snapshot_hour") >= 9
    out = f"{tmp_path}/m"
    load_movements(planned.where(~late), rail.changes_parquet.where("snapshot_ts < timestamp_ntz'2025-09-02 07:20:00'"), out)
    got = load_movements(planned.where(late), rail.changes_parquet.where("snapshot_ts >= timestamp_ntz'2025-09-02 07:20:00'"), out)
    _same(got, rail.movements_max)


def test_repeated_and_contradicting_rows_over_loads(spark, rail, tmp_path):
    # the identity is total: however the rows are cut into loads, the first member counts
    base = resolve_planned(rail.planned, rail.stations)
    other = base.withColumn("member", F.concat(F.lit("0"), "member")).withColumn("train_number", F.lit("before"))
    later = base.withColumn("member", F.concat(F.lit("z"), "member")).withColumn("train_number", F.lit("after"))
    none = rail.changes_parquet.limit(0)
    whole = load_movements(base.unionByName(base).unionByName(other).unionByName(later), none, f"{tmp_path}/whole")
    assert {r.train_number for r in whole.collect()} == {"before"} and whole.count() == rail.movements_max.count()
    for n, parts in enumerate(([base, base, other.unionByName(later)], [other, base.unionByName(base)], [later, base, other])):
        for part in parts:
            got = load_movements(part, none, f"{tmp_path}/m{n}")
        _same(got, whole)


def test_a_load_writes_its_own_rows_only(spark, rail, tmp_path):
    planned = resolve_planned(rail.planned, rail.stations)
    big = planned.crossJoin(spark.range(400)).withColumn("stop_id", F.concat("stop_id", F.col("id").cast("string"))).drop("id")
    load_movements(big, rail.changes_parquet, f"{tmp_path}/m")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "m" / "data").rglob("*.parquet")}
    load_movements(planned.limit(1), rail.changes_parquet.limit(1), f"{tmp_path}/m")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "m" / "data").rglob("*.parquet")}
    assert before.items() <= after.items()
    rows = [spark.read.parquet(str(p)).count() for p in after.keys() - before.keys()]
    assert sum(rows) <= 2


def test_killed_loads_leave_the_old_tables(spark, rail, tmp_path, monkeypatch):
    path, st = _weeks(tmp_path), str(rail.root / "station_data.json")
    etl_star(spark, path("p1"), path("c1"), st, f"{tmp_path}/s")
    state = lambda: {n: sorted(map(str, t.collect())) for n, t in read_star(spark, f"{tmp_path}/s").items()}
    old, real, kills = state(), store.Load.append, 0
    real_commit = store.Load.commit
    while True:
        left = kills

        def append(self, *args, **kwargs):
            nonlocal left
            real(self, *args, **kwargs)
            if left == 0:
                raise KeyboardInterrupt("killed")
            left -= 1

        def commit(self):
            raise KeyboardInterrupt("killed")
        monkeypatch.setattr(store.Load, "append", append)
        monkeypatch.setattr(store.Load, "commit", commit)
        with pytest.raises(KeyboardInterrupt):
            etl_star(spark, path("p2"), path("c2"), st, f"{tmp_path}/s")
        assert state() == old
        if left > 0:         # killed by the commit: every write was cut once before
            break
        kills += 3
    monkeypatch.setattr(store.Load, "append", real)
    monkeypatch.setattr(store.Load, "commit", real_commit)
    got = etl_star(spark, path("p2"), path("c2"), st, f"{tmp_path}/s")
    whole = etl_star(spark, path("p1", "p2"), path("c1", "c2"), st, f"{tmp_path}/whole")
    assert got["fact_train_movements"].count() == whole["fact_train_movements"].count()
    new = state()
    store.TableSet(spark, f"{tmp_path}/s").vacuum()
    assert state() == new


def test_deltas_are_compacted_in_tiers(spark, rail, tmp_path):
    rows = rail.changes_star
    stops = sorted(r.stop_id for r in rows.select("stop_id").distinct().collect())
    for n in range(store.FAN * 2 + 1):
        load_changes(rows.where(F.col("stop_id") == stops[n % len(stops)]), f"{tmp_path}/c", "last")
    tables = store.TableSet(spark, f"{tmp_path}/c")
    assert sorted(d["tier"] for d in tables.deltas("changes")) == [0, 1, 1]
    load_changes(rows, f"{tmp_path}/one", "last")
    _same(read_change_state(spark, f"{tmp_path}/c", "last"), read_change_state(spark, f"{tmp_path}/one", "last"))


def test_two_loads_at_once(spark, rail, tmp_path):
    one, two = (store.TableSet(spark, f"{tmp_path}/t").load() for _ in range(2))
    one.append("a", spark.range(3))
    two.append("a", spark.range(5))
    one.commit()
    with pytest.raises(RuntimeError):
        two.commit()
    assert store.TableSet(spark, f"{tmp_path}/t").read("a").count() == 3


def test_changes_of_known_stops_are_not_joined_for_the_unmatched(spark, rail, tmp_path, monkeypatch):
    def never(*args):
        raise AssertionError("all changes are shuffled although few stops are missing")
    monkeypatch.setattr(incremental, "unmatched_changes", never)
    changes = rail.changes_star.unionByName(rail.changes_star.limit(1).withColumn("stop_id", F.lit(None).cast("string")))
    out = f"{tmp_path}/star"
    for _ in range(2):
        got = load_star(rail.planned, changes, rail.stations, out)
    _same(got["unmatched_timetable_changes"], merge.unmatched_changes(changes, rail.planned).distinct())
    monkeypatch.undo()
    monkeypatch.setattr(incremental, "FEW_STOPS", 0)
    _same(load_star(rail.planned, changes, rail.stations, f"{tmp_path}/many")["unmatched_timetable_changes"],
          got["unmatched_timetable_changes"])


def test_a_last_value_and_its_place_share_one_buffer(spark):
    rows = spark.createDataFrame([("a", 1, "m", "x", True), ("a", 2, "m", None, False), ("a", 2, "k", "y", None), (None, 1, "m", "z", None)],
                                 "stop_id string, day int, member string, changed_platform string, cancelled boolean")
    rows = rows.select("stop_id", F.timestamp_seconds("day").cast("timestamp_ntz").alias("snapshot_ts"), "member", "changed_platform",
                       "cancelled", *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("changed_arrival_time", "changed_departure_time")])
    parts = [fold.fold_state(rows.where(F.second("snapshot_ts") == day), "last") for day in (1, 2)]
    whole = fold.merge_deltas(parts[0].unionByName(parts[1]), "last")
    assert {(r.stop_id, r.changed_platform, r.cancelled) for r in whole.collect()} == {("a", "y", True), (None, "z", None)}
    _same(whole.select("stop_id", "changed_platform", "cancelled"), fold.fold_changes(rows, "last").select("stop_id", "changed_platform", "cancelled"))
    assert not any("max_by" in s._jdf.queryExecution().toString() for s in (parts[0], whole))
