"""Hand-made rail fixture (FIXTURES.md §B): five stations, four trips,
change snapshots, one empty and one malformed document, written as real
station JSON and real tar.gz archives, then read back through the
library's own readers."""

from __future__ import annotations

import io
import json
import tarfile
from types import SimpleNamespace

# name -> (eva, lon, lat)
STATIONS = {
    "Berlin Alexanderplatz": (1, 13.41, 52.52),
    "Berlin Ostkreuz": (2, 13.47, 52.50),
    "Berlin-Wedding": (3, 13.37, 52.54),
    "Berlin-Spandau": (4, 13.20, 52.53),
    "Potsdam Hbf": (5, 13.07, 52.39),
}
A, O, W, S = "Berlin Alexanderplatz", "Berlin Ostkreuz", "Berlin-Wedding", "Berlin-Spandau"

# (stop_id, station, (ar pt, pp) | None, (dp pt, pp) | None, snapshot)
PLANNED = [
    ("-111-2509020700-1", A, None, ("2509020700", "1"), "2509020700"),
    ("-111-2509020700-2", O, ("2509020708", "2"), ("2509020709", "3"), "2509020700"),
    ("-111-2509020700-3", W, ("2509020720", "4"), None, "2509020700"),
    ("222-2509020715-1", O, None, ("2509020715", "1"), "2509020700"),
    ("222-2509020715-2", S, ("2509020740", "1"), None, "2509020700"),
    ("333-2509021705-1", W, None, ("2509021705", "1"), "2509021700"),
    ("333-2509021705-3", S, ("2509021730", "2"), None, "2509021700"),
    ("-444-2509030900-1", A, None, ("2509030900", "1"), "2509030900"),
    ("-444-2509030900-2", W, ("2509030910", "1"), None, "2509030900"),
]

# (snapshot, station, stop_id, ar attrs, dp attrs)
CHANGES = [
    ("2509020715", O, "-111-2509020700-2", {"ct": "2509020712", "cp": "5"}, {"ct": "2509020713"}),
    ("2509020730", O, "-111-2509020700-2", {"ct": "2509020710"}, {"ct": "2509020711", "cp": "10"}),
    ("2509020715", O, "222-2509020715-1", None, {"cs": "c"}),
    ("2509030845", A, "-444-2509030900-1", None, {"ct": "2509030858"}),
    ("2509020745", "Berlin Nordkreuz", "999-2509020800-1", {"ct": "2509020805"}, None),
]


def station_json() -> str:
    result = []
    for name, (eva, lon, lat) in STATIONS.items():
        result.append({
            "number": str(eva * 10), "ifopt": f"de:11000:{eva}", "name": name,
            "mailingAddress": {"city": name.split()[0].split("-")[0], "zipcode": "10000", "street": "Main 1"},
            "category": 2, "priceCategory": 2,
            "hasParking": True, "hasBicycleParking": False, "hasLocalPublicTransport": True,
            "hasPublicFacilities": True, "hasLockerSystem": False, "hasTaxiRank": True,
            "hasTravelNecessities": True, "hasSteplessAccess": "partial",
            "hasMobilityService": "no" if eva % 2 else "Yes, on request",
            "hasWiFi": True, "hasTravelCenter": False, "hasRailwayMission": False, "hasDBLounge": False,
            "hasLostAndFound": True, "hasCarRental": False, "federalState": "Berlin",
            "regionalbereich": {"number": 7, "name": "RB Ost", "shortName": "RB O"},
            "aufgabentraeger": {"shortName": "VBB", "name": "Verkehrsverbund"},
            "timeTableOffice": {"email": "x@example.org", "name": "Office"},
            "szentrale": {"number": 1, "publicPhoneNumber": "000", "name": "Zentrale"},
            "stationManagement": {"number": 9, "name": "Mgmt"},
            "evaNumbers": [{"number": eva, "geographicCoordinates": {"coordinates": [lon, lat]}}],
            "ril100Identifiers": [{"rilIdentifier": f"B{eva}", "hasSteamPermission": True,
                                   "steamPermission": "restricted",
                                   "geographicCoordinates": {"coordinates": [lon, lat]},
                                   "primaryLocationCode": f"P{eva}"}],
            "productLine": {"productLine": "S-Bahn", "segment": "city"},
        })
    return json.dumps({"result": result})


def _attrs(d: dict) -> str:
    return "".join(f' {k}="{v}"' for k, v in d.items())


def planned_docs() -> dict[str, str]:
    """member path -> XML text"""
    by_doc: dict[tuple[str, str], list[str]] = {}
    for stop_id, station, ar, dp, snap in PLANNED:
        trip = stop_id.lstrip("-").split("-")[0]
        inner = f'<tl f="N" t="p" o="800" c="S" n="{trip}"/>'
        if ar:
            inner += f'<ar pt="{ar[0]}" pp="{ar[1]}" ppth="Origin {trip}|{station}"/>'
        if dp:
            inner += f'<dp pt="{dp[0]}" pp="{dp[1]}" ppth="{station}|Terminus {trip}"/>'
        by_doc.setdefault((snap, station), []).append(f'<s id="{stop_id}">{inner}</s>')
    docs = {f"{snap}/{station}/timetable.xml": f'<timetable station="{station}">{"".join(ss)}</timetable>'
            for (snap, station), ss in by_doc.items()}
    docs["2509020800/Potsdam Hbf/timetable.xml"] = '<timetable station="Potsdam Hbf"/>'
    docs["2509020800/Berlin-Wedding/broken.xml"] = '<timetable station="Berlin-Wedding"><s id="1">'
    return docs


def change_docs() -> dict[str, str]:
    by_doc: dict[tuple[str, str], list[str]] = {}
    for snap, station, stop_id, ar, dp in CHANGES:
        inner = (f"<ar{_attrs(ar)}/>" if ar is not None else "") + (f"<dp{_attrs(dp)}/>" if dp is not None else "")
        by_doc.setdefault((snap, station), []).append(f'<s id="{stop_id}">{inner}</s>')
    eva = {n: v[0] for n, v in STATIONS.items()}
    return {f"{snap}/{station}/changes.xml":
            f'<timetable station="{station}" eva="{eva.get(station, 99)}">{"".join(ss)}</timetable>'
            for (snap, station), ss in by_doc.items()}


def write_tar(path, docs: dict[str, str]) -> None:
    with tarfile.open(path, "w:gz") as tar:
        for name, text in docs.items():
            data = text.encode("utf-8")
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def build(spark, root) -> SimpleNamespace:
    from railflow.plans.pipelines import build_movements, build_star
    from railflow.sources.archives import read_archives
    from railflow.sources.stations import read_stations
    from railflow.sources.timetables import (
        change_elements_from_xml, change_rows, planned_elements_from_xml, planned_rows,
    )
    (root / "timetables").mkdir()
    (root / "timetable_changes").mkdir()
    (root / "station_data.json").write_text(station_json())
    write_tar(root / "timetables" / "250902_250909.tar.gz", planned_docs())
    write_tar(root / "timetable_changes" / "250902_250909.tar.gz", change_docs())
    stations = read_stations(spark, str(root / "station_data.json")).cache()
    planned_docs_df = read_archives(spark, str(root / "timetables" / "*.tar.gz")).cache()
    change_docs_df = read_archives(spark, str(root / "timetable_changes" / "*.tar.gz")).cache()
    pe = planned_elements_from_xml(planned_docs_df)
    ce = change_elements_from_xml(change_docs_df)
    return SimpleNamespace(
        root=root, stations=stations, planned_docs=planned_docs_df, change_docs=change_docs_df,
        planned_elements=pe, change_elements=ce,
        planned=planned_rows(pe), changes_parquet=change_rows(ce, "parquet"),
        changes_star=change_rows(ce, "star"),
        movements_max=build_movements(pe, ce, stations, policy="max", platform_rule="parquet").cache(),
        movements_last=build_movements(pe, ce, stations, policy="last", platform_rule="star").cache(),
        star=build_star(pe, ce, stations),
    )
