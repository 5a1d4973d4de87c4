"""Which publications a report should have, and which are held."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hindcast.functions.time import ZONE, expected_hours
from hindcast.schemas import Report


def expected_publications(days: DataFrame, report: Report, zone: str = ZONE) -> DataFrame:
    """(day, hour, expected): local hours in which a publication is due, as often as the hour occurs."""
    if report.daily_at is not None:
        return days.select("day", F.lit(report.daily_at).alias("hour"), F.lit(1).cast("bigint").alias("expected"))
    rows = expected_hours(days, "day", zone).select("day", (F.col("hour_ending") - 1).alias("hour"))
    return rows.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("expected"))


def measure(held: DataFrame, expected: DataFrame, zone: str = ZONE, published: str = "publication_ts_utc") -> DataFrame:
    """(day, hour, expected, held, credited, missing): a surplus in one hour makes up for no other."""
    local = F.from_utc_timestamp(published, zone)
    counts = held.groupBy(F.to_date(local).alias("day"), F.hour(local).alias("hour")).agg(F.count(F.lit(1)).alias("held"))
    rows = expected.join(counts, ["day", "hour"], "left").withColumn("held", F.coalesce("held", F.lit(0)))
    credited = F.least("held", "expected")
    return rows.withColumns({"credited": credited, "missing": F.col("expected") - credited})


def by_day(measured: DataFrame) -> DataFrame:
    """(day, expected, held, missing_hours): hours are named as often as they lack."""
    named = F.expr("flatten(array_sort(collect_list(if(missing > 0, array_repeat(hour, cast(missing as int)), array()))))")
    return measured.groupBy("day").agg(F.sum("expected").alias("expected"), F.sum("credited").alias("held"), named.alias("missing_hours"))


def missing(measured: DataFrame) -> DataFrame:
    """One row for each missing publication: (day, hour)."""
    return measured.where("missing > 0").select("day", "hour", F.explode(F.sequence(F.lit(1), F.col("missing"))).alias("_n")).drop("_n")


def gap_runs(measured: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Runs of due hours that lack a publication: ``(*by, first_day, first_hour, last_day, last_hour, hours, missing)``.

    A run goes on over midnight, over hours in which nothing is due, and over clock changes, as it follows the calendar of
    due hours. It ends where an hour has all it should. There is a row for each due hour of a report, a few thousand a
    year, in one task each."""
    calendar = Window.partitionBy(*[F.col(c) for c in by], *([] if by else [F.lit(0)])).orderBy("day", "hour")
    rows = measured.withColumn("_n", F.row_number().over(calendar)).where("missing > 0")
    rows = rows.withColumn("_run", F.col("_n") - F.row_number().over(calendar))
    first, last = F.min(F.struct("day", "hour")), F.max(F.struct("day", "hour"))
    runs = rows.groupBy(*by, "_run").agg(first.alias("a"), last.alias("b"), F.count(F.lit(1)).alias("hours"), F.sum("missing").alias("missing"))
    return runs.select(*by, F.col("a.day").alias("first_day"), F.col("a.hour").alias("first_hour"), F.col("b.day").alias("last_day"), F.col("b.hour").alias("last_hour"), "hours", "missing")


def attribute_gaps(days: DataFrame, listed: DataFrame) -> DataFrame:
    """Why days are incomplete, by the number that the archive lists (``listed``: day, listed)."""
    rows = days.join(listed, "day", "left").where("held < expected")
    cause = F.when(F.col("listed").isNull(), "unknown").when(F.col("listed") <= F.col("held"), "never published").otherwise("not retrieved")
    return rows.withColumn("cause", cause)


def percentage(held: Column, expected: Column) -> Column:
    return F.when(expected == 0, 100.0).otherwise(100.0 * held / expected)


@dataclass(frozen=True)
class Coverage:
    report_key: str
    expected: int
    held: int
    missing: tuple[tuple[date, int], ...]

    @property
    def pct(self) -> float:
        return 100.0 * self.held / self.expected if self.expected else 100.0

    def summary(self) -> str:
        lines = [f"{self.report_key}: {self.held}/{self.expected} publications ({self.pct:.1f}%)"]
        return "\n".join(lines + [f"  missing {day} hour {hour:02d}" for day, hour in self.missing])


def coverage(spark: SparkSession, files: DataFrame, report: Report, start: date, end: date) -> Coverage:
    """Coverage of the days from ``start`` to ``end``; days without any file are missing whole."""
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
    measured = measure(files.where(F.col("report_key") == report.key), expected_publications(days, report)).cache()
    total = measured.agg(F.coalesce(F.sum("expected"), F.lit(0)).alias("e"), F.coalesce(F.sum("credited"), F.lit(0)).alias("h")).first()
    lacking = tuple((r["day"], r["hour"]) for r in missing(measured).orderBy("day", "hour").collect())
    measured.unpersist()
    return Coverage(report.key, total["e"], total["h"], lacking)


def retrieval_report(covered: list[Coverage], gaps: list[tuple[str, date, str]]) -> str:
    """A Markdown report of what is held and why the rest is not."""
    lines = ["# Retrieval report", "", "| report | held | expected | % |", "| --- | ---: | ---: | ---: |"]
    lines += [f"| {c.report_key} | {c.held} | {c.expected} | {c.pct:.1f} |" for c in covered]
    if gaps:
        lines += ["", "| report | day | cause |", "| --- | --- | --- |", *[f"| {r} | {d} | {c} |" for r, d, c in gaps]]
    return "\n".join(lines) + "\n"


#: Gap runs that a statement spells out; the others are counted.
RUNS = 20


def _section(spark: SparkSession, files: DataFrame, report: Report, start: date, end: date, listed: DataFrame | None) -> list[str]:
    """One report's part of a statement. To the driver come a row for each incomplete day and ``RUNS`` runs."""
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
    measured = measure(files.where(F.col("report_key") == report.key), expected_publications(days, report)).cache()
    known = (listed.where(F.col("report_key") == report.key) if listed is not None else spark.createDataFrame([], "day date, listed bigint")).select("day", "listed")
    short = attribute_gaps(measured.groupBy("day").agg(F.sum("expected").alias("expected"), F.sum("credited").alias("held")), known).orderBy("day").collect()
    total = measured.agg(F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"), F.coalesce(F.sum("credited"), F.lit(0)).alias("held"), percentage(F.coalesce(F.sum("credited"), F.lit(0)), F.coalesce(F.sum("expected"), F.lit(0))).alias("pct")).first()
    gaps = gap_runs(measured).cache()
    counted, shown = gaps.agg(F.count(F.lit(1)).alias("n"), F.max("hours").alias("longest")).first(), gaps.orderBy("first_day", "first_hour").limit(RUNS).collect()
    gaps.unpersist()
    measured.unpersist()
    out = [f"## {report.key}", "", f"Local days {start} to {end}: {total['held']} of {total['expected']} publications are held ({total['pct']:.1f} %).", ""]
    if not short:
        return [*out, "Nothing is missing.", ""]
    out += ["| day | due | held | listed | cause |", "| --- | ---: | ---: | ---: | --- |"]
    out += [f"| {r['day']} | {r['expected']} | {r['held']} | {'-' if r['listed'] is None else r['listed']} | {r['cause']} |" for r in short]
    causes = {c: sum(r["cause"] == c for r in short) for c in ("never published", "not retrieved", "unknown")}
    told = {"never published": "the archive lists no more than is held", "not retrieved": "the archive lists more: fetch them again", "unknown": "the archive was not asked"}
    out += ["", *[f"* {n} incomplete days: {told[c]}." for c, n in causes.items() if n]]
    out += ["", f"{counted['n']} runs of hours without a publication, the longest of {counted['longest']} hours:", ""]
    out += [f"* {r['first_day']} {r['first_hour']:02d}:00 to {r['last_day']} {r['last_hour']:02d}:59, {r['missing']} publications" for r in shown]
    return [*out, *([f"* and {counted['n'] - RUNS} runs more"] if counted["n"] > RUNS else []), ""]


def statement(spark: SparkSession, files: DataFrame, windows: dict[Report, tuple[date, date]], listed: DataFrame | None = None) -> str:
    """What is held of each report in its window, day by day where it is incomplete, why, and which hours are missing.

    ``files`` is a scan (names are enough), ``listed`` what an archive lists: (report_key, day, listed)."""
    lines = ["# What is held", "", "Counted from the files' names.", ""]
    for report, (start, end) in windows.items():
        lines += _section(spark, files, report, start, end, listed)
    lines += ["## What it means", "", "A publication that is missing matters only where it would have been the last one before a target's deadline; the readiness gate tells where a forecast is then missing or stale.", ""]
    return "\n".join(lines)
