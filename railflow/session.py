"""SparkSession helpers.

Library code never creates its own session: every function takes DataFrames
(or a session passed in by the caller).  ``get_session`` is for tests, the
bench and ad-hoc use; on a cluster the caller's session and its settings win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a local run needs; a cluster session brings its own.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "railflow") -> SparkSession:
    master = master or os.environ.get("RAILFLOW_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("RAILFLOW_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is (an unset value is an error there).  Only in local mode, when it
    is unset, a fresh scratch folder is created for this process.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not readable by other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(iterative searches and dense keys checkpoint there)")
        configured = tempfile.mkdtemp(prefix="railflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
