"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.io import shared_folder

_MADE: list[tuple[SparkSession, str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, removed when the application ends in order."""
    path = f"{shared_folder(spark).rstrip('/')}/riskframe-llm/{spark.sparkContext.applicationId}/{name}-{uuid4().hex[:12]}"
    if not _MADE:
        atexit.register(_remove)
    _MADE.append((spark, path))
    return path


def _remove() -> None:
    for spark, path in _MADE:
        with contextlib.suppress(Exception):  # the session may have ended before
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in a new shared folder: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
