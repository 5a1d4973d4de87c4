"""Parquet tables whose partitions of a processing date change all together.

A run writes its rows of all tables to folders of their own, ``<table>/processing_date=D/run_id=R``; then one small
manifest, written to a new name and renamed, says which run stands for D. Readers go by the manifest, so they see the
rows of one run in all tables, or of the run before; a crash leaves the old manifest. Commits of D have numbers, and a
number is claimed by creating a file that must not exist yet: of two writers with one number one is told. Evaluations
are published the same way. Renaming, claiming and reading manifests use Hadoop's file system of the path, so a
warehouse may lie in any store that Spark writes to and that creates files exclusively.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.schemas import TABLES


_COMMITS, _EVALUATIONS, _EVALUATION = "_manifest", "_evaluations", "evaluation_dataset"


class Conflict(RuntimeError):
    """Another writer's commit came before."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _published(self, log: str) -> dict[str, tuple[int, str]]:
        """Of each key of a log the last number, and what was published under it."""
        fs, folder = self._fs(f"{self.root}/{log}")
        found: dict[str, tuple[int, str]] = {}
        for name in [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []:
            if name.count(".") == 3 and not name.startswith("_"):  # key.number.folder.json
                key, number, where, _ = name.split(".")
                found[key] = max(found.get(key, (-1, "")), (int(number), where))
        return found

    def _publish(self, log: str, key: str, where: str, told: dict, expected: int | None) -> int:
        """Put a manifest in place under the next number, or under ``expected + 1`` and no other."""
        fs, folder = self._fs(f"{self.root}/{log}")
        fs.mkdirs(folder)
        number = self._published(log).get(key, (-1, ""))[0]
        if expected is not None and number != expected:
            raise Conflict(f"{key}: commit {number} was made since {expected} was read")
        while True:
            number += 1
            if fs.createNewFile(self._fs(f"{self.root}/{log}/_claim-{key}.{number}")[1]):
                break
            if expected is not None:
                raise Conflict(f"{key}: another writer has claimed commit {number}")
        _, temporary = self._fs(f"{self.root}/{log}/_{uuid.uuid4().hex}")
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        if not fs.rename(temporary, self._fs(f"{self.root}/{log}/{key}.{number}.{where}.json")[1]):
            raise OSError(f"the manifest of {key} could not be put in place")
        return number

    def runs(self) -> dict[str, str]:
        """The run that stands for each processing date."""
        return {day: run for day, (_, run) in self._published(_COMMITS).items()}

    def version(self, day: date) -> int:
        """The number of the commit that stands for a day; -1 before the first."""
        return self._published(_COMMITS).get(str(day), (-1, ""))[0]

    def commit(self, tables: dict[str, DataFrame], day: date, run_id: str, expected: int | None = None) -> int:
        """Replace the partition of ``day`` in all tables; a table without rows is then empty for that day.

        Whoever builds on what stood (``expected``: its ``version``) is told by a ``Conflict`` if that was replaced
        meanwhile; without it, the last of several writers stands. Returns the version."""
        attempt = uuid.uuid4().hex
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.root}/{name}/processing_date={day}/run_id={run_id}-{attempt}")
        return self._publish(_COMMITS, str(day), f"{run_id}-{attempt}", {"processing_date": str(day), "run_id": run_id, "tables": sorted(tables)}, expected)

    def publish_evaluation(self, rows: DataFrame, eval_id: str) -> None:
        """An evaluation under its id, in place of one before: readers have the old or the new one, whole."""
        where = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/{_EVALUATION}/{eval_id}/{where}")
        self._publish(_EVALUATIONS, eval_id, where, {"eval_id": eval_id}, None)

    def evaluation(self, eval_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{_EVALUATION}/{eval_id}/{self._published(_EVALUATIONS)[eval_id][1]}")

    def vacuum(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete the folders of runs and evaluations that no manifest makes stand, and staging that was left behind.

        Readers of an older manifest and writers before their commit keep theirs while it is younger than the limit."""
        limit = (time.time() - older_than_hours * 3600) * 1000
        standing = {f"{name}/processing_date={day}/run_id={run}" for name in TABLES for day, run in self.runs().items()}
        standing |= {f"{_EVALUATION}/{key}/{where}" for key, (_, where) in self._published(_EVALUATIONS).items()}
        fs, top = self._fs(self.root)
        gone = []
        for pattern in (*[f"{name}/processing_date=*/run_id=*" for name in TABLES], f"{_EVALUATION}/*/*", "_staging-*"):
            for status in fs.globStatus(self._fs(f"{self.root}/{pattern}")[1]) or []:
                path = status.getPath()
                below = path.toUri().getPath()[len(fs.makeQualified(top).toUri().getPath()) + 1 :]
                if status.isDirectory() and below not in standing and self._newest(fs, path) < limit:
                    fs.delete(path, True)
                    gone.append(below)
        return sorted(gone)

    def _newest(self, fs, path) -> int:
        """When something in a folder was last written."""
        return max((s.getModificationTime() for s in fs.listStatus(path)), default=fs.getFileStatus(path).getModificationTime())

    def read(self, name: str, day: date | None = None) -> DataFrame:
        """A table's rows of the runs that stand; of one processing date, if given."""
        runs = {d: r for d, r in self.runs().items() if day is None or d == str(day)}
        schema = self.spark.createDataFrame([], TABLES[name].replace(" not null", "")).schema
        paths = [f"{self.root}/{name}/processing_date={d}/run_id={r}" for d, r in sorted(runs.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def create_views(self) -> None:
        """All tables as temporary views for SQL, as they stand now; those without a committed run are empty."""
        for name in TABLES:
            self.read(name).createOrReplaceTempView(name)

    def amend(self, name: str, day: date, where: Column, values: dict[str, Column]) -> None:
        """Set ``values`` where a condition holds, in one table's rows of ``day``: a new commit of all tables, so that
        readers see all rows changed or none. A ``Conflict`` if the day was committed meanwhile: nothing is changed then."""
        version, standing = self._published(_COMMITS)[str(day)]
        tables = {n: self.read(n, day) for n in TABLES}
        tables[name] = tables[name].withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})
        self.commit(tables, day, standing.rsplit("-", 1)[0], expected=version)

    @contextmanager
    def staging(self) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
        """Tables of a load that are computed once and read several times, beside the warehouse; they go at the end."""
        root = f"{self.root}/_staging-{uuid.uuid4().hex}"

        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{root}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{root}/{name}")

        try:
            yield staged
        finally:
            fs, folder = self._fs(root)
            fs.delete(folder, True)


def table_digest(df: DataFrame) -> DataFrame:
    """(rows, digest): the same for the same rows in any order, without gathering them."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).cast("string").alias("digest"))


def row_digest(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """The md5 of each group's rows, joined in order: for small groups, and to compare with other engines."""
    row = F.concat_ws(chr(31), *[F.col(c).cast("string") for c in columns])
    return df.groupBy(*by).agg(F.md5(F.array_join(F.sort_array(F.collect_list(row)), "|").cast("binary")).alias("digest"))


def portable_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """(rows, digest): the sum of 60 bits of each row's md5, in any order, which other engines compute alike."""
    row = F.concat_ws(chr(31), *[F.col(c).cast("string") for c in columns])
    number = F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(number).cast("string").alias("digest"))
