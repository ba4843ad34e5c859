"""Versioned sets of tables: loads add delta folders, one pointer publishes them.

A ``TableSet`` is a folder of the shared store::

    data/<table>/delta=<name>/... Parquet, written once and never changed
    versions/<n>.json             which folders make up each table in version n

The highest version is the pointer: a reader takes the folders that it lists and
nothing else.  A ``Load`` writes its rows into new folders and ends with a single
rename of the next version file, so all tables of the set change at once.  Killed at
any step before that, it leaves folders that no version lists (``vacuum`` removes
them) and readers see the old tables; after it they see the new ones.  A load
therefore writes its own rows only, whatever the size of the tables.

Rows that belong together over several deltas (states of one key) are merged by the
reader.  Deltas have tiers: when ``FAN`` of one tier have come together, the load that
completes them also writes their merge, one tier up, so a row is rewritten once per
tier and a reader never merges more than ``FAN`` deltas a tier.

Loads come one at a time.  If two run at once, the later finds its version taken and
fails without effect (on stores whose rename does not replace an existing file).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from railflow.operators.sinks import _file, remove

FAN = 8      # deltas of a tier that are merged into one of the next


def together(*steps: Callable[[], object]) -> list:
    """Run independent steps of a load at once (their Spark jobs share the cluster);
    the first failure is raised when all have ended."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


class TableSet:
    """The tables under ``root`` as of its latest version (or the one given)."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        numbers = self._versions()
        self.version = version if version is not None else max(numbers, default=0)
        self.tables: dict[str, dict] = self._listed() if self.version else {}

    def _versions(self) -> list[int]:
        store, folder = _file(self.spark, f"{self.root}/versions")
        if not store.exists(folder):
            return []
        names = [str(s.getPath().getName()) for s in store.listStatus(folder)]
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]

    def _listed(self) -> dict:
        store, file = _file(self.spark, f"{self.root}/versions/{self.version}.json")
        stream = store.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def deltas(self, name: str) -> list[dict]:
        return self.tables.get(name, {}).get("deltas", [])

    def read(self, name: str, deltas: list[dict] | None = None) -> DataFrame | None:
        """All rows of a table (of some of its deltas), or None if no load named it."""
        if name not in self.tables:
            return None
        deltas = self.deltas(name) if deltas is None else deltas
        schema = StructType.fromJson(self.tables[name]["schema"])
        if not deltas:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/data/{name}"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{d['folder']}" for d in deltas])
        return rows.select(*schema.names)       # without the folders' own column

    def load(self) -> Load:
        return Load(self)

    def vacuum(self) -> None:
        """Remove earlier versions, and folders that the latest does not list.  Not
        while a load runs or a reader still uses an earlier version."""
        for number in self._versions():
            if number < self.version:
                remove(self.spark, f"{self.root}/versions/{number}.json")
        store, data = _file(self.spark, f"{self.root}/data")
        for table in store.listStatus(data) if store.exists(data) else []:
            name = str(table.getPath().getName())
            kept = {d["folder"] for d in self.deltas(name)}
            for folder in store.listStatus(table.getPath()):
                if str(folder.getPath().getName()) not in kept:
                    store.delete(folder.getPath(), True)


class Load(TableSet):
    """The next version in the making: reads see what it has added so far."""

    def __init__(self, base: TableSet):
        self.spark, self.root, self.version = base.spark, base.root, base.version
        self.tables = json.loads(json.dumps(base.tables))

    def append(self, name: str, rows: DataFrame, partition_by: tuple[str, ...] | list[str] = (), tier: int = 0,
               settings: dict | None = None) -> None:
        """Add a delta to a table; none is added if there are no rows."""
        folder = f"delta=d{uuid.uuid4().hex}"
        path = f"{self.root}/data/{name}/{folder}"
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        for key, value in {"compression": "zstd", **(settings or {})}.items():
            writer = writer.option(key, value)
        writer.parquet(path)
        table = self.tables.setdefault(name, {"schema": json.loads(rows.schema.json()), "deltas": []})
        if self.spark.read.schema(rows.schema).parquet(path).isEmpty():
            remove(self.spark, path)
        else:
            table["deltas"].append({"folder": folder, "tier": tier})

    def compact(self, name: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
        """Merge the deltas of every tier that has ``fan`` of them into one of the next."""
        tier = 0
        while any(d["tier"] >= tier for d in self.deltas(name)):
            full = [d for d in self.deltas(name) if d["tier"] == tier]
            if len(full) >= fan:
                merged = merge(self.read(name, full))
                self.tables[name]["deltas"] = [d for d in self.deltas(name) if d["tier"] != tier]
                self.append(name, merged, tier=tier + 1)
            tier += 1

    def commit(self) -> TableSet:
        """Publish: from here on readers see this version."""
        number = self.version + 1
        store, file = _file(self.spark, f"{self.root}/versions/{number}.json")
        _, draft = _file(self.spark, f"{self.root}/versions/.draft-{uuid.uuid4().hex}")
        stream = store.create(draft, False)
        stream.write(bytearray(json.dumps(self.tables).encode()))
        stream.close()
        if store.exists(file) or not store.rename(draft, file):
            store.delete(draft, False)
            raise RuntimeError(f"version {number} of {self.root} was published by another load")
        return TableSet(self.spark, self.root, number)
