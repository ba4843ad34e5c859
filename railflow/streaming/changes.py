"""Incremental fold of timetable changes as they arrive.

``read_change_stream``  new ``.tar.gz`` archives in a folder -> change rows
                        (``binaryFile`` stream, the same untar and XML parsing as
                        the batch path)
``fold_into_state``     every micro-batch adds its fold to the change state that the
                        incremental loads keep (``incremental.read_change_state``):
                        one row per stop, equal to the batch fold of all changes so far;
                        a batch writes its own fold only, and full tiers of deltas merged

No watermark is needed and no change is ever dropped: the state lives in a table,
not in the stream, and merging is idempotent, so a batch replayed after a restart
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from railflow.functions.timefmt import snapshot_from_member
from railflow.plans.incremental import load_changes
from railflow.sources.archives import ARCHIVE_ROW_SCHEMA, _untar_content
from railflow.sources.timetables import parse_changes

# the fixed schema of Spark's binaryFile source
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_change_stream(spark: SparkSession, folder: str, platform_rule: str = "star",
                       max_files_per_trigger: int = 1) -> DataFrame:
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", "*.tar.gz")
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .load(folder))
    docs = (files.select("path", "content").mapInPandas(_untar_content, ARCHIVE_ROW_SCHEMA)
            .withColumn("snapshot_ts", snapshot_from_member("member")))
    return parse_changes(docs, platform_rule)


def fold_into_state(changes: DataFrame, path: str, checkpoint: str, policy: str = "max",
                    trigger: dict | None = None) -> StreamingQuery:
    """Start a query that keeps the fold state at ``path``.  ``checkpoint`` is
    the stream's own folder on the shared store; a restart must name the same."""
    def merge(batch: DataFrame, _: int) -> None:
        rows = batch.persist()     # read twice: by the test for rows and by the merge
        if not rows.isEmpty():
            load_changes(rows, path, policy)
        rows.unpersist()

    writer = changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()
