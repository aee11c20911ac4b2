"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; sizes stay with the cluster's own settings."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # text files may come in EUC-KR
        .config("spark.sql.legacy.javaCharsets", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the
    master is local, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = spark.conf.get("pathkin.local.dir", None)
        if not folder:
            folder = tempfile.mkdtemp(prefix="pathkin-")
            spark.conf.set("pathkin.local.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a frame that several branches of one plan use: the branches then read a
    compact table, and a lost executor costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Staged tables of one run in a folder of their own, removed when the run ends."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark, self.path = spark, scratch_path(spark, name)

    def stage(self, df: DataFrame, name: str, by: list[str] = []) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; one that isn't there is no fault."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
