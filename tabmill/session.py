"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Semantics the operators rely on; everything else is left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# The JVM does not compile methods beyond 8000 bytes of bytecode. Generated code of a wide table
# is larger; past this limit Spark evaluates it in smaller methods, which are compiled.
WIDE_TABLE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(app_name: str = "tabmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the required settings; ``master`` only for local work and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **WIDE_TABLE_CONF, "spark.sql.adaptive.enabled": "true", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else has built."""
    for key, value in {**REQUIRED_CONF, **WIDE_TABLE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = os.path.join(tempfile.gettempdir(), "tabmill-shared")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write once and read back: cuts the lineage and survives the loss of executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._scratch_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove what ``materialize`` wrote, once nothing reads it any more."""
    for df in stored:
        remove_path(df.sparkSession, df._scratch_path)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
