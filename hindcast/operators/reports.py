"""Report queries over the evaluation dataset and the actuals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators import metrics


def zone_series(evaluation: DataFrame, zone: str) -> DataFrame:
    """One zone's actual, forecast and naive values over time."""
    rows = evaluation.where(F.col("weather_zone") == zone)
    return rows.select("target_ts_utc", "actual_mw", "ercot_forecast_mw", "naive_forecast_mw").orderBy("target_ts_utc")


def reported_hours(actuals: DataFrame, day: date) -> DataFrame:
    """The hours that were reported for an operating day, in order."""
    return actuals.where(F.col("operating_date") == F.lit(day)).select("hour_ending", "dst_flag").distinct().orderBy("hour_ending", "dst_flag")


def evaluation_row(evaluation: DataFrame, zone: str, day: date, hour_ending: int) -> DataFrame:
    """The row of one zone and hour, with how long before its cutoff the forecast was published."""
    rows = evaluation.where((F.col("weather_zone") == zone) & (F.col("operating_date") == F.lit(day)) & (F.col("hour_ending") == hour_ending))
    return rows.select("weather_zone", "operating_date", "hour_ending", "dst_flag", "ercot_model", "ercot_forecast_mw", "actual_mw", "naive_forecast_mw", "ercot_error_mw", "naive_error_mw", "ercot_vintage_age_hours")


def highest_actual(evaluation: DataFrame) -> DataFrame:
    """The highest actual of all; the earliest, and the first zone, where several are equal."""
    return evaluation.where("actual_mw is not null").orderBy(F.col("actual_mw").desc(), "target_ts_utc", "weather_zone").limit(1).select("weather_zone", "target_ts_utc", "actual_mw")


def worst_cells(evaluation: DataFrame, model: str, n: int = 5) -> DataFrame:
    """The zones and hours of the day with the largest weighted errors."""
    _, error = metrics.MODELS[model]
    scored = evaluation.where(F.col("actual_mw").isNotNull() & F.col(error).isNotNull())
    rows = scored.groupBy("weather_zone", "hour_ending").agg(F.round(metrics.wape(F.abs(error)), 7).alias("wape_pct"))
    return rows.orderBy(F.col("wape_pct").desc(), "weather_zone", "hour_ending").limit(n)


def folds_side_by_side(evaluation: DataFrame) -> DataFrame:
    """The weighted error of each operating day, naive beside published; a day without either keeps the other."""
    naive, published = (metrics.scored(evaluation, m).groupBy("operating_date").agg(F.round(metrics.wape(), 7).alias(f"{m}_wape_pct")) for m in ("naive", "ercot"))
    return naive.join(published, "operating_date", "full")


def with_previous(publications: DataFrame, report: str, ts: str) -> DataFrame:
    """Add ``previous_ts``: the publication before, of the same report.

    One report may hold most rows, so the order is taken day by day, and the last publication of each day is carried
    over to the next day with one: no task holds more than a day of one report, or one row for each day.
    """
    rows = publications.withColumn("_day", F.to_date(ts))
    days = rows.groupBy(report, "_day").agg(F.max(ts).alias("_last"))
    before = days.select(report, "_day", F.lag("_last").over(Window.partitionBy(report).orderBy("_day")).alias("_before"))
    inside = F.lag(ts).over(Window.partitionBy(report, "_day").orderBy(ts))
    return rows.withColumn("_inside", inside).join(before, [report, "_day"], "left").withColumn("previous_ts", F.coalesce("_inside", "_before")).drop("_day", "_inside", "_before")


def newest(publications: DataFrame, ts: str, n: int) -> DataFrame:
    """The newest ``n`` publications, each time once."""
    return publications.select(ts).distinct().orderBy(F.col(ts).desc()).limit(n)


def zone_peak(rows: DataFrame, zone: str, value: str, tie: str) -> DataFrame:
    """The row of each zone with the highest value; at a tie, the first by ``tie``."""
    place = F.row_number().over(Window.partitionBy(zone).orderBy(F.col(value).desc(), tie))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")
