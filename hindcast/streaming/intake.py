"""Publications as a stream: files are normalised as they arrive. Late files need no watermark: what a file may be used
for follows from its publication time, and each micro-batch has its rows complete, as files are the unit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hindcast.functions.time import ZONE
from hindcast.operators import normalize
from hindcast.schemas import Report
from hindcast.sources.files import lines, publication_ts

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def arriving(spark: SparkSession, raw_root: str, report: Report, files_a_batch: int = 100) -> DataFrame:
    """The files of a report, as they appear."""
    stream = spark.readStream.format("binaryFile").schema(_BINARY).option("pathGlobFilter", "*_csv.zip").option("maxFilesPerTrigger", files_a_batch).load(f"{raw_root}/{report.key}")
    name = F.element_at(F.split("path", "/"), -1)
    sha = F.sha2("content", 256)
    return stream.select(F.lit(report.key).alias("report_key"), name.alias("original_filename"), publication_ts(name, ZONE).alias("publication_ts_utc"), F.substring(sha, 1, 16).alias("source_file_id"), sha.alias("content_sha256"), F.col("length").alias("size_bytes"), F.col("path").alias("local_path"), "content")


def intake(spark: SparkSession, raw_root: str, report: Report, sink: Callable[[DataFrame, DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Call ``sink(observations, ledger, batch id)`` for each batch of files. A batch that is repeated after a failure has
    the same id and the same rows, so a sink that writes under its id writes each file once."""

    def batch(files: DataFrame, number: int) -> None:
        classified = normalize.classify(lines(files), report)
        named = files.drop("content")
        sink(normalize.observations(classified, named, report), normalize.ledger(classified, named), number)

    writer = arriving(spark, raw_root, report).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()
