"""Readers, sinks, the materialise-once cache, and model artefacts."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.scalar import nan_to_null


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table with NaN read as NULL; only the named columns reach the scan."""
    df = spark.read.parquet(path)
    return nan_to_null(df.select(*columns) if columns else df)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the session's ``spark.checkpoint.dir``.

    Where it is unset on a local master (tests), a new temporary folder is made and set as checkpoint
    folder; on a cluster that would be another folder for each executor, so it is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    folder = folder or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        folder = tempfile.mkdtemp(prefix="riskframe-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application wrote."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(
    spark: SparkSession, build: Callable[[], DataFrame], path: str, force: bool = False
) -> DataFrame:
    """Table at ``path``, built and written only if it is absent, incomplete or ``force`` is set."""
    if force or not path_exists(spark, os.path.join(path, "_SUCCESS")):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def publish_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` over the catalog table ``name`` (data at ``path`` if given) and read it back."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, order: Sequence | None = None) -> None:
    """CSV files with header, in the given order across the files."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).csv(path)


def write_metrics(long: DataFrame, path: str) -> None:
    """Long metric table as JSON lines."""
    long.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str, info: dict) -> None:
    """Fitted pipeline and, beside it, thresholds, parameters and seed as one JSON row."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    row = spark.createDataFrame([(json.dumps(info, ensure_ascii=False),)], "value string")
    row.write.mode("overwrite").text(os.path.join(path, "info"))


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """The pair written by ``save_model``."""
    info = spark.read.text(os.path.join(path, "info")).first()["value"]
    return PipelineModel.load(path), json.loads(info)
