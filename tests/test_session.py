import os
import time

import pytest
from pyspark.sql import functions as F

from orderlens.session import scratch_path, shared_folder


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, context, **conf):
        self.sparkContext, self.conf = context, conf


def test_the_cluster_names_the_folder():
    session = Session(Context("yarn"), **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_folder(session) == "hdfs:///shared" and session.sparkContext.folder == "hdfs:///shared"
    assert shared_folder(Session(Context("yarn", "s3a://set/by/spark"))) == "s3a://set/by/spark"


def test_scratch_paths_are_new(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{shared_folder(spark)}/x-") and first != second


def test_queries_leave_the_session_as_it_is(spark, small):
    from orderlens.plans import all_queries

    other = spark.newSession()
    for key, value in (("spark.sql.session.timeZone", "America/New_York"), ("spark.sql.ansi.enabled", "false")):
        other.conf.set(key, value)
    settings = {k: other.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                                               "spark.sql.adaptive.forceOptimizeSkewedJoin")}
    for name in ("kpi_revenue_by_month", "etl_orders", "etl_calendar", "report_item_view"):
        query = all_queries()[name].build
        assert sorted(map(str, query(other, small).collect())) == sorted(map(str, query(spark, small).collect())), name
    assert {k: other.conf.get(k) for k in settings} == settings


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(Context("spark://host:7077")))


def test_a_local_session_gets_its_own():
    session = Session(Context("local[2]"))
    assert shared_folder(session) == session.sparkContext.folder


def test_finished_steps_leave_no_shuffle_files(spark, tmp_path):
    """Failed before: they stayed until the driver's garbage collector came upon them."""
    from orderlens.session import SHUFFLE_CLEANUP, shuffles_removed

    def shuffled():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles())
                if f.getName().startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    frame = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_removed(spark):
        frame.write.parquet(str(tmp_path / "stored"))
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert spark.read.parquet(str(tmp_path / "stored")).count() == 7
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        raise ZeroDivisionError
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_a_removed_scratch_path_is_gone(spark):
    from orderlens.session import remove

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    remove(spark, path)  # nothing there is no error
