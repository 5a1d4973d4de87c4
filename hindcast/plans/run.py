"""A run: files that were visible on a processing date, loaded, evaluated and gated."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hindcast.functions.time import ZONE, hours_in_day
from hindcast.operators import gates, normalize
from hindcast.operators.asof import Params, evaluation_dataset
from hindcast.plans.warehouse import Warehouse
from hindcast.schemas import REPORTS, TABLES
from hindcast.schemas import ZONES as WEATHER_ZONES
from hindcast.sources import files as sources

VERSION = "1.0.0"
OK, NOT_READY, NOT_RELEASED = 0, 1, 2


def local_midnight(day: date) -> datetime:
    return datetime.combine(day, time(), ZoneInfo(ZONE)).astimezone(UTC)


@dataclass(frozen=True)
class Context:
    run_id: str
    eval_id: str  # run_id and the parameters: evaluations of one load differ in it
    processing_date: date
    first_day: date
    last_day: date
    params: Params


def window(processing_date: date, days: int = 30, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """The operating days to judge: explicit bounds, or the ``days`` days before the processing date."""
    last = end or processing_date - timedelta(days=1)
    first = start or last - timedelta(days=days - 1)
    if first > last:
        raise ValueError(f"evaluation window starts after it ends: {first} .. {last}")
    if last >= processing_date:
        raise ValueError(f"evaluation window ends {last}, on or after the processing date {processing_date}")
    return first, last


def visible_until(processing_date: date) -> datetime:
    return local_midnight(processing_date + timedelta(days=1))


def visible(files: DataFrame, processing_date: date) -> DataFrame:
    """Files published before the local midnight that ends the processing date."""
    return files.where(F.col("publication_ts_utc") < F.lit(visible_until(processing_date)))


def run_id(files: DataFrame, processing_date: date, version: str = VERSION) -> str:
    """A hash of the version, the date and the files' contents: the same files give the same run."""
    hashes = F.array_join(F.sort_array(F.collect_list("content_sha256")), "")
    return files.agg(F.substring(F.sha2(F.concat(F.lit(version), F.lit(processing_date.isoformat()), hashes), 256), 1, 32)).first()[0]


def build_context(files: DataFrame, processing_date: date, *, cutoff_lag_hours: int = 24, seasonal_lag_days: int = 7, window_days: int = 30, window_start: date | None = None, window_end: date | None = None) -> Context:
    first, last = window(processing_date, window_days, window_start, window_end)
    params = Params(local_midnight(first), local_midnight(last + timedelta(days=1)), local_midnight(processing_date + timedelta(days=1)), cutoff_lag_hours, seasonal_lag_days)
    run = run_id(visible(files, processing_date), processing_date)
    return Context(run, f"{run}-{first}-{last}-{cutoff_lag_hours}-{seasonal_lag_days}", processing_date, first, last, params)


def _account() -> list[Column]:
    """What is counted while lines and their dispositions are written: their number, and which they are, in any order."""
    line = F.col("row_number") > 0
    return [F.count_if(line).alias("lines"), F.sum(F.when(line, F.xxhash64("local_path", "row_number").cast("decimal(38,0)"))).alias("which")]


class Unaccounted(RuntimeError):
    """A load whose lines and dispositions are not one to one; it names up to 20 files."""

    def __init__(self, report_key: str, files: DataFrame):
        self.files = [r["local_path"] for r in files.orderBy("local_path").limit(20).collect()]
        super().__init__(f"{report_key}: lines and dispositions differ in {', '.join(self.files)}")


def load(spark: SparkSession, raw_root: str, context: Context, files: DataFrame, staged: Callable[[DataFrame, str], DataFrame]) -> dict[str, DataFrame]:
    """The canonical tables of ``files``, those that are visible: all rows of all reports, lazily.

    Lines and their classification are staged, as several tables are made from each: a file is unzipped once. While they
    are written Spark counts them; the load fails before its commit if a line has no disposition or several.
    """
    parts: dict[str, list[DataFrame]] = {name: [] for name in TABLES}
    for report in REPORTS.values():
        named = files.where(F.col("report_key") == report.key)
        content = visible(sources.scan(spark, raw_root, report.key, content=True, until=visible_until(context.processing_date)), context.processing_date)
        seen, told = Observation(), Observation()
        lines = staged(sources.lines(content).observe(seen, *_account()), f"lines-{report.key}")
        classified = staged(normalize.classify(lines, report).observe(told, *_account()), f"classified-{report.key}")
        if seen.get != told.get:
            raise Unaccounted(report.key, normalize.unmatched(lines, classified))
        parts["source_row"].append(normalize.ledger(classified, named))
        parts["source_file"].append(named.join(normalize.file_facts(lines), "local_path"))
        parts["forecast_vintage" if report.is_forecast else "actual_vintage"].append(normalize.observations(classified, named, report))
    out = {}
    for name, frames in parts.items():
        df = frames[0]
        for other in frames[1:]:
            df = df.unionByName(other)
        df = df.withColumns({"run_id": F.lit(context.run_id), "processing_date": F.lit(context.processing_date)})
        schema = spark.createDataFrame([], TABLES[name]).schema
        out[name] = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    return out


def expected_rows(spark: SparkSession, first: date, last: date) -> int:
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    return days.agg(F.sum(hours_in_day(F.col("day")))).first()[0] * len(WEATHER_ZONES)


def run(spark: SparkSession, raw_root: str, warehouse: str, processing_date: date, reports: str | None = None, thresholds: gates.Thresholds = gates.Thresholds(), **options) -> tuple[int, list[gates.GateResult]]:
    """Files to verdict. Exit code 0: released; 1: refused or not ready; 2: the model gate failed."""
    store = Warehouse(spark, warehouse)
    with store.staging() as staged:
        files = staged(visible(sources.scan_all(spark, raw_root, until=visible_until(processing_date)), processing_date), "files")
        if files.isEmpty():
            return NOT_READY, []
        context = build_context(files, processing_date, **options)
        store.commit(load(spark, raw_root, context, files, staged), processing_date, context.run_id)
    tables = {name: store.read(name, processing_date) for name in TABLES}
    # a load holds every file that was visible: what earlier days have loaded is in it
    store.publish_evaluation(evaluation_dataset(tables["forecast_vintage"], tables["actual_vintage"], context.params), context.eval_id)
    evaluation = store.evaluation(context.eval_id)
    expected = expected_rows(spark, context.first_day, context.last_day)
    results = [gates.readiness(tables, evaluation, expected, context.run_id, processing_date, (context.first_day, context.last_day), thresholds)]
    if results[0].status == gates.PASS:
        results.append(gates.model_gate(evaluation, context.run_id, processing_date, thresholds))
    if reports:
        write_reports(results, reports)
    code = NOT_READY if results[0].status == gates.FAIL else NOT_RELEASED if results[1].status == gates.FAIL else OK
    return code, results


def write_reports(results: list[gates.GateResult], folder: str) -> None:
    import pathlib

    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    for r in results:
        pathlib.Path(folder, f"{r.processing_date}_{r.gate}.json").write_text(json.dumps(json.loads(r.to_json()), indent=2))
