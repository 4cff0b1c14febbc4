"""Cutting of lineage: tables of an operator's own that must outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; a temporary one only where the session has none and is local, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoints-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there from now on."""
    folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like kept(), but as columns: later steps read only those that they need."""
    path = f"{folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
