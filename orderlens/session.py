"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What our own sessions are built with. A session somebody else built is left as it is: timestamps carry no zone, and no
# expression relies on either setting.
OWN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "orderlens", master: str | None = None, shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` unset and let spark-submit decide."""
    # Recording the Python call site of every column expression costs more than planning the small reports.
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (OWN_CONF | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the cluster's ``spark.checkpoint.dir``. Only a local session that has none, as in
    tests, gets a temporary one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="orderlens-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so a rerun cannot read another run's files.

    Whatever is there when the application ends is removed then: results are lazy and may be read until that moment.
    """
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a scratch path that nothing reads any more, before the application ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Spark's own switch: the shuffle files of a finished SQL job are removed.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that end within the block leave no shuffle files behind. Otherwise these stay until the driver's garbage collector
    comes upon them, so a job of several steps keeps the shuffles of all of them. For steps whose result is stored: nothing
    reads their shuffles again. The session's setting is as it was afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
