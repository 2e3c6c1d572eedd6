"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from planledger.session import new_folder, stored

__all__ = ["importable", "new_folder", "qualified", "saved"]


def importable(spark: SparkSession) -> None:
    """Let Python workers that find this package at the driver's path import it from there,
    wherever the driver was started. On a cluster the package is installed or shipped as usual."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` as a URI, with the file system that Spark takes for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    return re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", uri))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: later steps do not compute it again,
    and no lost executor takes it along. ``planledger.session.scratch`` deletes it at its end."""
    return stored(df, name)
