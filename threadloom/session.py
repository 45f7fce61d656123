"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "threadloom") -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the caller of every column operation slows down large plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor reaches, under the one the session names.

    A local session that names none, as in tests, gets one of this machine; a cluster has to name it.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not f"{spark.conf.get('spark.master', '')}[".startswith("local["):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that every executor reaches")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="threadloom-")


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
