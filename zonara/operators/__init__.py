"""Raster, geometry, fill, statistics and series operators as DataFrame compositions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def unused(columns: list[str], stem: str) -> str:
    """A column name that a table does not have."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local master gets a folder of its own if that setting is absent; elsewhere executors could not share
    one, so it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="zonara-checkpoint-"))
    return sc.getCheckpointDir()


def work_folder(spark: SparkSession) -> str:
    """A new folder there."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
