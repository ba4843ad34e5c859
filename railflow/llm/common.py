"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railflow.session import ensure_checkpoint_dir

# Words of every contract: runs of anything but space and U+0009..U+000D.
WORD_GAP = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_staged: list[tuple[str, DataFrame]] = []   # folders written by ``stage`` and not yet deleted

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

HASH60 = 16 ** 15   # number of values of ``hash60``


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash60(*parts: Column) -> Column:
    """60-bit non-negative hash of the parts' text (the first 15 hex digits
    of an MD5), uniform and reproducible in any SQL engine."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sqrt_buckets(n: int) -> int:
    """About sqrt(n) buckets: bucket size and bucket table grow alike."""
    return max(1, math.isqrt(max(n, 1)))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder inside the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage
    is cut, and a lost executor costs no recomputation.  The shuffle files of the write
    go with its end, as nothing reads them any more.  ``compression``: Spark's own
    choice if not given; "zstd" holds no memory outside the heap."""
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    _staged.append((path, staged))
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for path, staged in [x for x in _staged if any(x[1] is t for t in tables)]:
        _staged.remove((path, staged))
        delete(staged.sparkSession, path)


def staged_tables() -> list[DataFrame]:
    return [t for _, t in _staged]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store the session's paths point to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """Array of words (see WORD_GAP); empty for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python
    workers can import it wherever it is installed on the driver.  The archive
    is served by the driver; no executor reads the driver's folder."""
    import railflow
    sc = spark.sparkContext
    root = Path(railflow.__file__).parent
    if sc.applicationId in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="railflow-ship-")) / "railflow_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
