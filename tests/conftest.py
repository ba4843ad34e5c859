import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from railflow.session import LOCAL_DEFAULTS
    builder = (SparkSession.builder.master("local[4]").appName("railflow-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="railflow-test-ckpt-")))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from railflow.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rail(spark, tmp_path_factory):
    from tests.handfixture import build
    return build(spark, tmp_path_factory.mktemp("rail"))
