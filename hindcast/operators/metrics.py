"""Forecast metrics: weighted errors overall, by operating day, by zone and at each day's peak hour."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators.quantiles import MOST_SENT, SORTED, exact_percentile, finite, largest_group, settled

MODELS = {"naive": ("naive_forecast_mw", "naive_error_mw"), "ercot": ("ercot_forecast_mw", "ercot_error_mw")}


def scored(evaluation: DataFrame, model: str = "naive") -> DataFrame:
    """The rows that can be scored: those with a forecast and an actual."""
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}")
    forecast, error = (F.col(c) for c in MODELS[model])
    rows = evaluation.where(F.col("actual_mw").isNotNull() & forecast.isNotNull())
    return rows.select("weather_zone", "operating_date", "target_ts_utc", "actual_mw", forecast.alias("forecast_mw"), error.alias("error_mw"), F.abs(error).alias("abs_error_mw"))


def wape(error: str | Column = "abs_error_mw", actual: str | Column = "actual_mw") -> Column:
    """100 times the sum of absolute errors over the sum of actuals; null where that is 0."""
    return F.lit(100.0) * F.sum(error) / F.nullif(F.sum(actual), F.lit(0.0))


def ape(error: Column, actual: Column) -> Column:
    return F.lit(100.0) * error / F.nullif(actual, F.lit(0.0))


def _ape() -> Column:
    return ape(F.col("abs_error_mw"), F.col("actual_mw"))


def summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows, WAPE, mean absolute error, bias, and the exact 95th percentile of the absolute percentage error.

    Groups of up to ``quantiles.SORTED`` rows are one aggregate; where one is larger, its percentile is searched for
    without gathering it."""
    sums = [F.count(F.lit(1)).alias("rows"), wape().alias("wape_pct"), F.avg("abs_error_mw").alias("mae_mw"), F.avg("error_mw").alias("bias_mw")]
    if largest_group(rows, by) <= SORTED:
        return rows.groupBy(*by).agg(*sums, F.percentile(finite(_ape()), 0.95).alias("p95_ape_pct"))
    high = exact_percentile(rows, by, _ape(), 0.95, "p95_ape_pct")
    if not by:  # one row each
        return rows.agg(*sums).join(F.broadcast(high), F.lit(True), "left")
    own = high.select(*[F.col(c).alias(f"_{c}") for c in by], "p95_ape_pct")
    return rows.groupBy(*by).agg(*sums).join(own, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left").select(*by, "rows", "wape_pct", "mae_mw", "bias_mw", "p95_ape_pct")


def ranked_peaks(rows: DataFrame) -> DataFrame:
    """Add ``peak_rank`` by actual in each zone and operating day; the earlier hour comes first at a tie."""
    return rows.withColumn("peak_rank", F.row_number().over(Window.partitionBy("weather_zone", "operating_date").orderBy(F.col("actual_mw").desc(), "target_ts_utc")))


def peak_rows(rows: DataFrame) -> DataFrame:
    return ranked_peaks(rows).where("peak_rank = 1")


def zone_scores(rows: DataFrame) -> DataFrame:
    """Of each zone: rows, WAPE, and the largest errors at peak hours.

    The peak of a zone's day is its earliest row with the day's greatest actual. The greatest actuals are a first
    aggregate, a row for each zone and day, which is sent to all tasks while it is small; the second meets only rows that
    reach them. Both keep partial sums, so no row is shuffled or sorted. A day without actuals has its first hour."""
    day = ["weather_zone", "operating_date"]
    sums = rows.groupBy(*day).agg(F.count(F.lit(1)).alias("rows"), F.sum("abs_error_mw").alias("error"), F.sum("actual_mw").alias("actual"), F.max("actual_mw").alias("top"))
    sums, n = settled(sums)
    tops = sums.select(*[F.col(c).alias(f"_{c}") for c in day], "top")
    near = F.broadcast(tops) if n <= MOST_SENT else tops
    at_top = rows.join(near, [*[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in day], F.col("actual_mw").eqNullSafe(F.col("top"))])
    peaks = at_top.groupBy(*day).agg(F.min_by("abs_error_mw", "target_ts_utc").alias("error"), F.min_by(_ape(), F.col("target_ts_utc")).alias("ape"))
    errors = peaks.groupBy("weather_zone").agg(F.max("error").alias("peak_hour_abs_error_mw"), F.max("ape").alias("peak_hour_ape_pct"))
    wape_pct = F.lit(100.0) * F.sum("error") / F.nullif(F.sum("actual"), F.lit(0.0))
    zones = sums.groupBy("weather_zone").agg(F.sum("rows").alias("rows"), wape_pct.alias("wape_pct"))
    errors = errors.withColumnRenamed("weather_zone", "_zone")
    return zones.join(F.broadcast(errors) if n <= MOST_SENT else errors, F.col("weather_zone").eqNullSafe(F.col("_zone"))).select("weather_zone", "rows", "wape_pct", "peak_hour_abs_error_mw", "peak_hour_ape_pct")


@dataclass(frozen=True)
class Fold:
    operating_date: date
    rows: int
    wape_pct: float | None
    mae_mw: float
    bias_mw: float


@dataclass(frozen=True)
class ZoneScore:
    weather_zone: str
    rows: int
    wape_pct: float | None
    peak_hour_abs_error_mw: float
    peak_hour_ape_pct: float | None


@dataclass(frozen=True)
class Evaluation:
    model: str
    rows: int
    wape_pct: float
    mae_mw: float
    bias_mw: float
    p95_ape_pct: float
    worst_fold_wape_pct: float
    peak_hour_wape_pct: float
    max_peak_hour_ape_pct: float
    folds: tuple[Fold, ...]
    zones: tuple[ZoneScore, ...]
    wape_undefined: bool = False  # wape_pct is then 0.0

    def to_dict(self) -> dict:
        """Rounded: percentages to four digits, MW to three."""

        def tidy(x: dict) -> dict:
            digits = lambda k: 4 if k.endswith("pct") else 3
            return {k: round(v, digits(k)) if isinstance(v, float) else v.isoformat() if isinstance(v, date) else v for k, v in x.items()}

        return tidy({k: v for k, v in asdict(self).items() if k not in ("folds", "zones", "wape_undefined")}) | {"folds": [tidy(asdict(f)) for f in self.folds], "zones": [tidy(asdict(z)) for z in self.zones]}


def evaluate(evaluation: DataFrame, model: str = "naive") -> Evaluation:
    """Score a model on a run's evaluation dataset. What comes to the driver is one row for each day and each zone."""
    rows = ranked_peaks(scored(evaluation, model)).cache()
    try:
        peak = rows.where("peak_rank = 1")
        total = summary(rows, []).first()
        top = peak.agg(wape().alias("wape"), F.max(_ape()).alias("ape")).first()
        folds = tuple(Fold(r["operating_date"], r["rows"], r["wape_pct"], r["mae_mw"], r["bias_mw"]) for r in summary(rows, ["operating_date"]).orderBy("operating_date").collect())
        zones = tuple(ZoneScore(*r) for r in zone_scores(rows.drop("peak_rank")).orderBy("weather_zone").collect())
    finally:
        rows.unpersist()
    worst = max((f.wape_pct for f in folds if f.wape_pct is not None), default=0.0)
    return Evaluation(model, total["rows"], *(total[c] or 0.0 for c in ("wape_pct", "mae_mw", "bias_mw", "p95_ape_pct")), worst, top["wape"] or 0.0, top["ape"] or 0.0, folds, zones, total["wape_pct"] is None)
