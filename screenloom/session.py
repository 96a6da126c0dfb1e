"""Session settings and the one way in which jobs cut their lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", app: str = "screenloom", **extra: str) -> SparkSession:
    """Local session with the settings that every query of this package expects."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | extra
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only where neither that setting nor a checkpoint folder exists (tests on one machine) a temporary
    folder is set; on a cluster that would not be shared, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="screenloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later jobs survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """As ``cut``, but as a Parquet table, so that later jobs read only the columns they need.

    The table lies in the shared checkpoint folder and goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a table of ``stage`` that nothing reads any more, so that its disk is free before the application ends."""
    jvm = df.sparkSession._jvm
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        if "/staged-" in path:
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_screenloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="screenloom-package-"), "screenloom.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("screenloom", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._screenloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
