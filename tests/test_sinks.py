"""Partitioned Parquet sink: round trip and idempotent re-run (K1, K2)."""

import tempfile

from pyspark.sql import functions as F

from railflow.operators.sinks import PARTITION_COLUMNS, write_movements
from railflow.schemas import MOVEMENT_COLUMNS


def test_round_trip_and_rerun(spark, rail):
    out = tempfile.mkdtemp(prefix="railflow-sink-") + "/train_movements"
    mv = rail.movements_max
    write_movements(mv, out)
    back = spark.read.parquet(out)
    # partition columns move to the end when read back
    assert back.columns == [c for c in MOVEMENT_COLUMNS if c not in PARTITION_COLUMNS] + PARTITION_COLUMNS
    assert back.count() == mv.count()
    write_movements(mv, out)                       # same week again: replaced, not appended
    assert spark.read.parquet(out).count() == mv.count()
    one_snapshot = mv.filter(F.col("snapshot_hour") == 17)
    write_movements(one_snapshot, out)             # other partitions untouched
    assert spark.read.parquet(out).count() == mv.count()
    final = spark.read.parquet(out)                # the listing of `back` is stale now
    assert final.exceptAll(mv.select(*final.columns)).count() == 0


def test_star_tables_write(spark, rail):
    from railflow.operators.sinks import write_table
    root = tempfile.mkdtemp(prefix="railflow-star-")
    for name, df in rail.star.items():
        write_table(df, f"{root}/{name}")
        assert spark.read.parquet(f"{root}/{name}").count() == df.count()
