"""Finished parts of a long run, kept in a shared folder, so that a new run goes on where a lost one ended.

A part is named by what it depends on: a fingerprint of its input and its settings. It is written to a path of its own; only
then an entry that names the path is written, so a part is either whole or absent, and two runs that make the same part do
not disturb each other. Reading a part also cuts lineage.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from hashlib import md5
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.io import path_exists, shared_folder


def fingerprint(df: DataFrame) -> str:
    """Row count, sum and exclusive or of the rows' hashes: the same for the same rows in any order, in one aggregation."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    row = df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    return md5(json.dumps([df.schema.simpleString(), *map(str, row)]).encode()).hexdigest()


class Ledger:
    """Parts below ``folder``: entries in ``entries``, data in ``parts``."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/riskframe/run-{uuid4().hex}"

    def _entry(self, key: Mapping) -> str:
        return f"{self.folder}/entries/{md5(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()}"

    def done(self, key: Mapping) -> bool:
        return path_exists(self.spark, f"{self._entry(key)}/_SUCCESS")

    def _made(self, key: Mapping, write: Callable[[str], None]) -> str:
        """Path of the part, written first where it is missing."""
        entry = self._entry(key)
        if not self.done(key):
            start = time.time()
            path = f"{self.folder}/parts/{uuid4().hex}"
            write(path)
            text = json.dumps({"key": dict(key), "path": path, "seconds": round(time.time() - start, 3)}, sort_keys=True, default=str)
            self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(entry)
            return path
        return json.loads(self.spark.read.text(entry).first()["value"])["path"]

    def table(self, key: Mapping, build: Callable[[], DataFrame]) -> DataFrame:
        return self.spark.read.parquet(self._made(key, lambda path: build().write.parquet(path)))

    def model(self, key: Mapping, build: Callable[[], PipelineModel]) -> PipelineModel:
        return PipelineModel.load(self._made(key, lambda path: build().write().save(path)))

    def value(self, key: Mapping, build: Callable[[], object]):
        """A small value that JSON can hold."""
        rows = lambda: self.spark.createDataFrame([(json.dumps(build()),)], "value string")
        return json.loads(self.table(key, rows).first()["value"])

    def entries(self) -> DataFrame:
        """Rows (key, path, seconds) of the finished parts; the key is JSON."""
        text = self.spark.read.text(f"{self.folder}/entries/*")
        return text.select(*[F.get_json_object("value", f"$.{c}").alias(c) for c in ("key", "path", "seconds")])
