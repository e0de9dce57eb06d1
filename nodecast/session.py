"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot leaves a longer method uncompiled: wide rows then go through split, compiled ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("nodecast")
    local = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (SETTINGS | local | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All calendar arithmetic here is in UTC; code generated for wide rows stays compiled."""
    for setting in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(setting, SETTINGS[setting])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster the
    executors would not share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="nodecast-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/nodecast-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for a table or model that ``release`` may remove."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Used where several jobs read one expensive result.  Unlike a cache it
    survives lost executors, and unlike ``checkpoint()`` it stays columnar, so
    each reader still fetches only its columns.  All tables of an application
    lie in one folder, which ``release`` removes.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application.  To be called when
    no DataFrame that was built on them will be read any more."""
    discard(spark, _own_folder(spark))


def discard(spark: SparkSession, path: str) -> None:
    """Remove one intermediate table, of which nothing will be read any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def forget(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of tables that nobody refers to any more,
    which it otherwise does when the driver happens to be short of memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
