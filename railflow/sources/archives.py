"""Weekly ``.tar.gz`` archives of snapshot folders -> one row per XML member.

gzip cannot be split, so each archive is one task; right after the untar
the rows are spread over the cluster (round-robin repartition) so parsing
and everything after it run at full width.

Two ways in:

* ``path`` (default): only the archive path travels; the task streams the file
  itself through ``pyarrow.fs`` (local, HDFS, S3, ...), whatever its size;
* ``content``: ``binaryFile`` hands each archive to a task as one binary value
  (Spark caps a value at 2 GB), for stores that ``pyarrow.fs`` does not know.

The untar is the one Python step of the pipeline (``mapInPandas``); everything
downstream is JVM-side.  Rows leave in batches of at most ``BATCH_ROWS`` members or
about ``BATCH_BYTES`` of text, so a worker holds one member and one batch.
"""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from railflow.functions.timefmt import snapshot_from_member

ARCHIVE_ROW_SCHEMA = "archive string, member string, xml string"
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def _members(fileobj, archive: str):
    with tarfile.open(fileobj=fileobj, mode="r|gz") as tar:
        for member in tar:
            if not member.isfile():
                continue
            data = tar.extractfile(member).read()
            try:
                text = data.decode("utf-8")
            except UnicodeDecodeError:
                text = None      # quarantined by the parsers, never altered
            yield archive, member.name, text


def _batched(rows):
    buf, size = [], 0
    for row in rows:
        buf.append(row)
        size += len(row[2] or "")
        if len(buf) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pd.DataFrame(buf, columns=["archive", "member", "xml"])
            buf, size = [], 0
    if buf:
        yield pd.DataFrame(buf, columns=["archive", "member", "xml"])


def _untar_content(batches):
    def rows():
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                yield from _members(io.BytesIO(content), path)
    yield from _batched(rows())


def _untar_path(batches):
    from pyarrow import fs as pafs

    def rows():
        for pdf in batches:
            for path in pdf["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(path)
                # raw bytes: tarfile does the gunzip (pyarrow would by extension)
                with filesystem.open_input_stream(inner, compression=None) as stream:
                    yield from _members(stream, path)
    yield from _batched(rows())


def read_archives(spark: SparkSession, paths, mode: str = "path",
                  partitions: int | None = None) -> DataFrame:
    """``paths``: a path, glob or list of them.  Returns
    ``archive, member, xml, snapshot_ts`` (``snapshot_ts`` NULL when the
    member path has no ``YYMMDDHHMM`` folder: such members are quarantined
    by the parsers, not fatal)."""
    files = spark.read.format("binaryFile").load(paths)
    if mode == "content":
        docs = files.select("path", "content").mapInPandas(_untar_content, ARCHIVE_ROW_SCHEMA)
    elif mode == "path":
        docs = files.select("path").mapInPandas(_untar_path, ARCHIVE_ROW_SCHEMA)
    else:
        raise ValueError("mode must be 'content' or 'path'")
    n = partitions or spark.sparkContext.defaultParallelism
    return docs.repartition(n).withColumn("snapshot_ts", snapshot_from_member("member"))
