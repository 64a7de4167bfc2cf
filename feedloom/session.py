"""Session settings and the shared scratch folder that cuts lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Session settings that hold at any scale; sizes (memory, shuffle partitions) are the deployment's.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.sql.maxPlanStringLength": "20000",
}


def local_session(cores: int = 8, app: str = "feedloom", memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions or cores)).config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """This session's own folder within the one all executors share, the session's spark.checkpoint.dir.

    Only a local master, as in tests, may leave that unset: a folder of this machine is made then. On a cluster, where
    executors could not read it, RuntimeError is raised.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: with master {master!r} a folder that all executors share is needed")
        folder = "file://" + tempfile.mkdtemp(prefix="feedloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(shutil.rmtree, folder.removeprefix("file://"), ignore_errors=True)
    return f"{folder.rstrip('/')}/feedloom-{spark.conf.get('spark.app.id', 'session')}"


def clean(spark: SparkSession) -> bool:
    """Remove what this session wrote to the shared folder; results that were not written elsewhere can't be read afterwards."""
    where = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step", path: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Write df as Parquet into the shared folder (to path where given, in partitions by columns) and read it back.

    Used where a result is read more than once or recomputing it would run Python again. Unlike a cache it
    survives the loss of an executor, is columnar, and later reads prune columns and push filters into it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path, partitionBy=list(by) or None)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
