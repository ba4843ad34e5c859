"""End-to-end flows on the hand fixture: archives + station JSON -> Parquet."""

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from railflow.plans.incremental import read_movements, read_star
from railflow.plans.pipelines import etl_movements, etl_star
from railflow.sources.archives import read_archives


def test_etl_movements_writes_partitioned_fact(spark, rail):
    out = tempfile.mkdtemp(prefix="railflow-e1-") + "/train_movements"
    root = rail.root
    etl_movements(spark, str(root / "timetables" / "*.tar.gz"), str(root / "timetable_changes" / "*.tar.gz"),
                  str(root / "station_data.json"), out)
    back = read_movements(spark, out)["train_movements"]
    assert back.count() == 9
    row = back.filter(F.col("stop_id") == "-111-2509020700-2").first()
    assert (row.arrival_delay_minutes, row.departure_delay_minutes, row.eva_number) == (4, 4, 2)
    assert sorted(r.snapshot_hour for r in back.select("snapshot_hour").distinct().collect()) == [7, 9, 17]
    # running the week again replaces it
    etl_movements(spark, str(root / "timetables" / "*.tar.gz"), str(root / "timetable_changes" / "*.tar.gz"),
                  str(root / "station_data.json"), out)
    assert read_movements(spark, out)["train_movements"].count() == 9
    folders = {p.name for p in Path(out).rglob("snapshot_hour=*")}
    assert folders == {"snapshot_hour=7", "snapshot_hour=9", "snapshot_hour=17"}


def test_etl_star_writes_six_tables(spark, rail):
    out = tempfile.mkdtemp(prefix="railflow-e2-")
    root = rail.root
    etl_star(spark, str(root / "timetables" / "*.tar.gz"), str(root / "timetable_changes" / "*.tar.gz"),
             str(root / "station_data.json"), out)
    tables = read_star(spark, out)
    counts = {t: tables[t].count() for t in
              ["dim_station", "dim_train", "dim_date", "dim_time", "fact_train_movements",
               "unmatched_timetable_changes"]}
    assert counts["dim_station"] == 5 and counts["fact_train_movements"] == 9
    assert counts["unmatched_timetable_changes"] == 1 and counts["dim_date"] == 2
    fact = tables["fact_train_movements"]
    # every planned stop found its station, train, date and time keys
    assert fact.filter(F.col("station_id").isNull() | F.col("train_id").isNull()
                       | F.col("date_id").isNull() | F.col("time_id").isNull()).count() == 0
    row = fact.filter(F.col("stop_id") == "-111-2509020700-2").first()
    assert (row.arrival_delay_minutes, row.changed_platform) == (2, "10")


def test_archive_path_mode_equals_content_mode(spark, rail):
    glob = str(rail.root / "timetables" / "*.tar.gz")
    a = read_archives(spark, glob, mode="content").select("member", "xml")
    b = read_archives(spark, glob, mode="path").select("member", "xml")
    assert a.count() == 10 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_members_without_snapshot_are_quarantined(spark):
    from railflow.sources.timetables import change_elements_from_xml, malformed_documents, parse_changes
    from tests.handfixture import write_tar
    root = tempfile.mkdtemp(prefix="railflow-q-")
    good = '<timetable station="X" eva="7"><s id="1-2509020700-1"><ar ct="2509020701"/></s></timetable>'
    write_tar(f"{root}/w.tar.gz", {
        "2509020715/X/changes.xml": good,
        "incoming/X/changes.xml": good,                       # no YYMMDDHHMM folder
        "2509020730/X/broken.xml": '<timetable station="X"><s id="2">',
        "2509020745/X/empty.xml": '<timetable station="X" eva="7"/>',
    })
    docs = read_archives(spark, f"{root}/*.tar.gz")
    rows = parse_changes(docs).collect()
    assert [(r.stop_id, r.eva_raw) for r in rows] == [("1-2509020700-1", 7)]
    bad = sorted(r.member for r in malformed_documents(docs, "change").collect())
    assert bad == ["2509020730/X/broken.xml", "incoming/X/changes.xml"]
    assert change_elements_from_xml(docs).count() == 1


def test_archives_leave_in_batches_of_bytes(spark, monkeypatch):
    from railflow.sources import archives
    from tests.handfixture import write_tar
    root = tempfile.mkdtemp(prefix="railflow-big-")
    docs = {f"2509020700/X/{i}.xml": f"<timetable>{'x' * 200_000}{i}</timetable>" for i in range(60)}     # 12 MB
    write_tar(f"{root}/big.tar.gz", docs)
    paths = [f"file://{root}/big.tar.gz"]
    import pandas as pd
    sizes = [sum(map(len, b["xml"])) for b in archives._untar_path([pd.DataFrame({"path": paths})])]
    assert len(sizes) == 2 and max(sizes) < archives.BATCH_BYTES + 300_000
    got = {r.member: r.xml for r in read_archives(spark, root + "/*.tar.gz").collect()}
    assert got == docs


def test_last_station_of_a_name_wins(spark, tmp_path):
    import json

    from railflow.plans.pipelines import STATION_ORDER, resolve_planned
    from railflow.sources.stations import read_stations
    one = lambda name, eva: {"name": name, "evaNumbers": [{"number": eva}]}
    (tmp_path / "s.json").write_text(json.dumps({"result": [one("A", 9), one("B", 2), one("A", 3)]}))
    stations = read_stations(spark, str(tmp_path / "s.json"), STATION_ORDER)
    planned = spark.createDataFrame([("A",), ("B",), ("C",)], "station_name string")
    got = {r.station_name: r.eva_number for r in resolve_planned(planned, stations).collect()}
    assert got == {"A": 3, "B": 2, "C": None}
