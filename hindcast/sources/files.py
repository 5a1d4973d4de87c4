"""Publication files as DataFrames: a scan of zip files, their lines, and the grammar of their names."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from hindcast.functions.time import ZONE
from hindcast.schemas import REPORTS, Report

#: ``cdr.<type id>.<sequence>.<YYYYMMDD>.<HHMMSSmmm>.<marker>_csv.zip`` (a fixed format), stamped in local time.
NAME = r"^cdr\.([0-9]{8})\.([0-9]{16})\.([0-9]{8})\.([0-9]{6})([0-9]{3})\.([A-Za-z0-9]+)_csv\.zip$"
SOURCE = "report_key string, original_filename string, publication_ts_utc timestamp, source_file_id string, content_sha256 string, size_bytes bigint, local_path string"


LINES = "local_path string, header string, row_number bigint, raw_line string, fields array<string>"
#: Lines that leave Python at once.
BATCH_LINES = 8192


def _stamp(filename: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(filename, NAME, "$3 $4.$5"), F.lit("yyyyMMdd HHmmss.SSS"))


def publication_ts(filename: Column, zone: str = ZONE) -> Column:
    """The instant of a file name; a name of another form is an error."""
    stamp = _stamp(filename)
    bad = F.raise_error(F.concat(F.lit("unrecognised file name: "), filename)).cast("timestamp")
    return F.when(filename.rlike(NAME) & stamp.isNotNull(), F.to_utc_timestamp(stamp, zone)).otherwise(bad)


def file_name(report: Report, published: Column, sequence: int = 0, zone: str = ZONE) -> Column:
    """The name of a publication; in the repeated hour two instants have one name."""
    local = F.from_utc_timestamp(published, zone)
    return F.concat(F.lit(f"cdr.{report.type_id:0>8}.{sequence:016d}."), F.date_format(local, "yyyyMMdd.HHmmssSSS"), F.lit(f".{report.marker}_csv.zip"))


def listed(files: DataFrame, since: datetime | None = None, until: datetime | None = None, zone: str = ZONE) -> DataFrame:
    """Of a scan of files those published from ``since`` to before ``until``, by their names alone.

    The condition is on the files' metadata, so Spark applies it to the listing: files outside are not opened. A name of
    another form passes, so that whoever reads its time fails on it."""
    published = F.to_utc_timestamp(_stamp(F.col("_metadata.file_name")), zone)
    inside = F.lit(True)
    if since is not None:
        inside &= F.coalesce(published >= F.lit(since), F.lit(True))
    if until is not None:
        inside &= F.coalesce(published < F.lit(until), F.lit(True))
    return files.where(inside)


def scan(spark: SparkSession, raw_root: str, report_key: str, *, content: bool = False, digest: bool = True, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The files of one report under ``raw_root/report_key``, of all times or of those between two instants; a folder that
    is missing gives an empty table.

    Files outside of the instants are never opened. Without ``content`` and ``digest`` none is: the table then has names,
    times and sizes, and null hashes. Spark packs small files into partitions by their bytes."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*_csv.zip").load(f"{raw_root}/{report_key}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SOURCE + (", content binary" if content else ""))
    files = listed(files, since, until)
    name = F.element_at(F.split("path", "/"), -1)
    sha = F.sha2("content", 256) if digest else F.lit(None).cast("string")
    return files.select(
        F.lit(report_key).alias("report_key"),
        name.alias("original_filename"),
        publication_ts(name).alias("publication_ts_utc"),
        F.substring(sha, 1, 16).alias("source_file_id"),
        sha.alias("content_sha256"),
        F.col("length").alias("size_bytes"),
        F.col("path").alias("local_path"),
        *(["content"] if content else []),
    )


def scan_all(spark: SparkSession, raw_root: str, **options) -> DataFrame:
    first, *rest = (scan(spark, raw_root, key, **options) for key in REPORTS)
    for df in rest:
        first = first.unionByName(df)
    return first


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each file, unzipped as a stream: no file's lines are held as a whole."""

    def rows(path: str, header: str, start: int, lines: list[str]) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([header] * n), pa.array(range(start, start + n), pa.int64()), pa.array(lines)], ["local_path", "header", "row_number", "raw_line"])

    for batch in batches:
        for path, content in zip(batch.column("local_path"), batch.column("content"), strict=True):
            path = path.as_py()
            with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                members = [m for m in z.namelist() if m.lower().endswith(".csv")]
                if len(members) != 1:
                    raise ValueError(f"{path}: expected one csv member, found {len(members)}")
                header, held, number = None, [], 2
                with z.open(members[0]) as member:
                    for text in io.TextIOWrapper(member, "utf-8-sig"):
                        for line in text.splitlines():  # it also knows rarer line ends
                            if header is None:
                                header = line
                            else:
                                held.append(line)
                        if len(held) >= BATCH_LINES:
                            yield rows(path, header, number, held)
                            number, held = number + len(held), []
                if held:
                    yield rows(path, header, number, held)
                elif number == 2:  # a file without data still has a header
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([header or ""]), pa.array([0], pa.int64()), pa.array([None], pa.string())], ["local_path", "header", "row_number", "raw_line"])


def split_fields(line: Column) -> Column:
    """The fields of one line of comma-separated values.

    A field that starts with a quote ends with the next single one (two stand for a quote) and takes in what follows up
    to the comma; without an end it takes in the rest. Elsewhere quotes are plain. An empty line has no fields, a null
    line null."""
    field = r'"(?:[^"]|"")*+(?:"[^,]*+)?|[^,]*+'
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({field})"), F.lit(1))
    inside = r'^"((?:[^"]|"")*+)"?(.*)$'

    def plain(f: Column) -> Column:
        return F.when(f.startswith('"'), F.concat(F.replace(F.regexp_extract(f, inside, 1), F.lit('""'), F.lit('"')), F.regexp_extract(f, inside, 2))).otherwise(f)

    return F.when(line == "", F.array().cast("array<string>")).when(~F.contains(line, F.lit('"')), F.split(line, ",", -1)).otherwise(F.transform(quoted, plain))


def lines(files: DataFrame) -> DataFrame:
    """The data lines of scanned files (with ``content``): numbered from 2, as the header is line 1, and split.

    A zip must have one csv member. A file without data lines gives one row of number 0 that carries its header. Spark has
    no zip reader: bytes pass through Python to be unzipped, in batches of ``BATCH_LINES`` lines; fields are split by
    Spark, each line by itself, so that a stray quote spoils its own line alone.
    """
    unzipped = files.select("local_path", "content").mapInArrow(_read, "local_path string, header string, row_number bigint, raw_line string")
    return unzipped.withColumn("fields", split_fields(F.col("raw_line")))


def parse_listing(spark: SparkSession, html: DataFrame, report: Report) -> DataFrame:
    """Advertised publications in listing pages ``(html)`` or ``(page, html)``: filename, document id, publication time;
    newest first.

    Names of other products are left out. A name that is listed twice is one publication, with its last document: that of
    the greatest ``page``, and in it of the last place. Without ``page``, pages that disagree are taken by their text."""
    order = F.col("page") if "page" in html.columns else F.lit(0)
    pair = r"(cdr\.[0-9]{8}\.[0-9]{16}\.[0-9]{8}\.[0-9]{9}\.[A-Za-z0-9]+_csv\.zip)[^?]*\?doclookupId=([0-9]+)"
    rows = html.select(order.alias("page"), "html", F.posexplode(F.arrays_zip(F.regexp_extract_all("html", F.lit(pair), F.lit(1)).alias("filename"), F.regexp_extract_all("html", F.lit(pair), F.lit(2)).alias("doc_id"))).alias("at", "x"))
    rows = rows.select(F.struct("page", F.xxhash64("html"), "at").alias("at"), "x.filename", "x.doc_id").where(F.col("filename").contains(report.marker))
    last = rows.groupBy("filename").agg(F.max_by("doc_id", "at").alias("doc_id"))
    return last.withColumn("publication_ts_utc", publication_ts(F.col("filename"))).orderBy(F.col("publication_ts_utc").desc(), "filename")
