"""Session factory and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "paperloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    n = os.cpu_count() if cores == "*" else int(cores)
    settings = {
        **LOCAL_DEFAULTS,
        "spark.sql.shuffle.partitions": str(n),
        "spark.default.parallelism": str(n),
        "spark.driver.memory": "16g",
        **conf,
    }
    settings.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="paperloom-"))
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, else one below the warehouse.

    Every executor must see it, so a folder of the driver's machine is refused unless the whole
    session runs there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    folder = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not named and folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the folder of intermediate tables; for the end of a session that has one of its own."""
    remove(spark, shared_dir(spark))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table that no step reads again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
