"""Session helper for local work, and storage that jobs may share."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "profitgrid") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def one_process(master: str) -> bool:
    """Whether driver and executors are one process; those of ``local-cluster`` are not."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The setting, or else the folder given to ``setCheckpointDir``, must name storage that every executor sees.
    Only a local master, where driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not one_process(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="profitgrid-")
    folder = f"{base.rstrip('/')}/profitgrid-{uuid.uuid4().hex}"
    context._profitgrid_folders = [*getattr(context, "_profitgrid_folders", []), folder]
    return folder


def remove_stored(spark: SparkSession) -> int:
    """Delete what this session has stored in shared folders so far; returns the number of folders.

    For the time after a result has been written: frames that read these folders are of no use any more.
    """
    context, removed = spark.sparkContext, 0
    for folder in getattr(context, "_profitgrid_folders", []):
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        removed += bool(path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True))
    context._profitgrid_folders = []
    return removed


def stored_together(*frames: DataFrame) -> list[DataFrame]:
    """``stored_once`` for frames that do not depend on each other, by jobs that run side by side."""
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(stored_once, frames))


def stored_once(df: DataFrame) -> DataFrame:
    """Store rows that several later steps read, so that a lost executor does not repeat their work.

    A Parquet table rather than a checkpoint: later steps read only the columns they use, and its
    size tells Spark how to join it.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
