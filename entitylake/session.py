"""Session set-up for local runs and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def local_session(
    app: str = "entitylake", cpus: int | str = "*", shuffle_partitions: int | None = None
) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    partitions = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # otherwise every Column call looks up its place in the Python source
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of its own, since there driver and tasks share a disk;
    that folder goes when the process ends.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="entitylake-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path for one intermediate table in the shared folder; never reused."""
    path = f"{checkpoint_root(spark)}/entitylake/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process, once the results that read them are written.

    Results are lazy and may read these tables, so only the caller knows when they are done with.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


def materialized(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once and read back: for results that several passes read."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
