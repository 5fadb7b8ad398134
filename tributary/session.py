"""Session settings and the shared folder used for checkpoints and hand-offs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the plans are written for. A cluster sets its own partition counts;
# adaptive execution sizes reducers, splits hot join keys and turns a join into
# a broadcast once the measured size of a side is under the threshold.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "tributary", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks, web page off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="tributary-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Unused path for a hand-off table below the shared folder.

    Whatever is there when the driver's JVM ends is removed with it.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).deleteOnExit(target)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever storage the path names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of the library's own, if it is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)
