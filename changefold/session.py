"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("changefold")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.numRecentProgressUpdates", "1000")
        .getOrCreate()
    )


#: Files that a task of a partitioned write may hold open.
OPEN_FILES = 16


def write_unsorted(spark: SparkSession) -> None:
    """Let tasks of a partitioned write keep a file open per partition, so that they need not sort their rows by partition first.

    A sort holds all rows of a task. Only from the `OPEN_FILES`th partition on does Spark sort the rest. A stream's sink asks its
    session anew for each batch, so this stays set; a session with a number of its own keeps it.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if int(spark.conf.get(name)) == 0:
        spark.conf.set(name, OPEN_FILES)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`, the cluster's shared storage.

    Only a local session without that setting falls back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix=f"changefold-{label}-")
