"""Parquet sinks.

``write_movements``  overwrites exactly the snapshot partitions present in the
                     rows given (dynamic partition overwrite).  The rows must be
                     *complete* for these partitions: an export of the merged fact
                     (``plans.incremental``), or of some of its snapshots.
``write_table``      whole-table overwrite.

Tables that loads are merged into are kept by ``operators.store``.

Rows are range-partitioned on the partition columns *and* ``stop_id`` before
writing: each task writes a contiguous key range (few files per folder) and a
hot snapshot is split over several tasks instead of landing on one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PARTITION_COLUMNS = ["snapshot_date", "snapshot_hour", "snapshot_minute"]


def write_movements(movements: DataFrame, path: str, partitions: int | None = None,
                    max_records_per_file: int = 5_000_000, layout: list[str] = PARTITION_COLUMNS) -> None:
    """``layout``: the columns that name the folders (a coarser choice suits
    data with few rows per snapshot)."""
    cols = list(layout) + ["stop_id"]
    ordered = (movements.repartitionByRange(partitions, *cols) if partitions
               else movements.repartitionByRange(*cols))
    (ordered.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*layout)
     .parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Whole-table overwrite; ``df`` must not read ``path``."""
    df.write.mode("overwrite").parquet(path)


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    store, target = _file(spark, path)
    store.delete(target, True)
