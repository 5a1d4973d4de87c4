"""Folders that the driver and all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
CLEAR = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints. Where none is named, a temporary one in local mode, where driver and
    executors are one process, and an error on a cluster, whose executors do not share such a folder."""
    named = spark.conf.get(KEY, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"name a folder that all executors share in {KEY}")
        named = "file://" + tempfile.mkdtemp(prefix="hindcast-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/hindcast/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends, not when the driver next collects garbage. For tables that
    are written once: nothing reads these shuffles again."""
    before = spark.conf.get(CLEAR, None)
    spark.conf.set(CLEAR, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAR) if before is None else spark.conf.set(CLEAR, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_cleared(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that a computation needs until its result is written: all others go at the end."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.tables = spark, new_path(spark, name), []

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_cleared(self.spark):
            df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def bucketed(self, df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
        """A table that Spark reads by ``key`` without an exchange; ``df`` has to be dealt by ``repartition(buckets, key)``."""
        self.tables.append(f"scratch_{uuid.uuid4().hex}")
        with shuffles_cleared(self.spark):
            df.write.bucketBy(buckets, key).option("path", f"{self.path}/{name}").saveAsTable(self.tables[-1])
        return self.spark.table(self.tables[-1])

    def result(self, df: DataFrame) -> DataFrame:
        return written(df, "result")

    def drop(self, name: str = "") -> None:
        """Delete a table of ``written``, or all."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def __exit__(self, *failed: object) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.drop()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
