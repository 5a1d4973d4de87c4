"""The registered queries: each operator applied to the driver's tables, with the same query in ANSI SQL.

Vintages are derived from ``events``: the zone is the event type, the publication is the event's time, the target lies
12 to 59 hours after it, and the value is the event's. All queries run over whole tables.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable
from datetime import date, datetime

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from hindcast.functions import time as T
from hindcast.operators import asof, gates, merkle, metrics, normalize, reports
from hindcast.operators.quantiles import sent
from hindcast.plans import coverage as cov
from hindcast.plans.warehouse import portable_digest, row_digest
from hindcast.sources import archive
from hindcast.sources.files import lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(c: str | Column) -> Column:
    """An instant without a zone, as DuckDB reads it."""
    return F.col(c).cast("timestamp_ntz") if isinstance(c, str) else c.cast("timestamp_ntz")


def vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    target = F.date_trunc("hour", ts) + T.hours((F.lit(12) + F.col("event_id") % 48).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("zone"), ts.alias("pub"), target.alias("target"), "value")


VINTAGES = "v AS (SELECT event_id, event_type AS zone, ts AS pub, date_trunc('hour', ts) + (12 + event_id % 48) * INTERVAL 1 HOUR AS target, value FROM events)"
DEADLINE = "pub <= target - INTERVAL 24 HOUR"


def deadline() -> Column:
    return F.col("target") - T.hours(24)


# ---------------------------------------------------------------- as-of selection


@query(f"""WITH {VINTAGES}, e AS (SELECT * FROM v WHERE {DEADLINE}), l AS (SELECT zone, target, max(pub) AS pub FROM e GROUP BY 1, 2),
a AS (SELECT l.zone, l.target, l.pub, min(value) AS value, count(DISTINCT value) AS value_count FROM l JOIN e USING (zone, target, pub) GROUP BY 1, 2, 3)
SELECT t.zone, t.target, a.pub, a.value, coalesce(a.value_count, 0) AS value_count FROM (SELECT DISTINCT zone, target FROM v) t LEFT JOIN a USING (zone, target)""")
def asof_latest_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: for each zone and target the latest value known 24 hours before, or none."""
    found = asof.latest_eligible(vintages(spark, sf_dir), ["zone", "target"], "pub", deadline(), ["value"], every_key=True)
    return found.select("zone", plain("target").alias("target"), plain("pub").alias("pub"), "value", "value_count")


def _tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("zone"), (F.date_trunc("day", ts) + F.make_dt_interval((F.lit(1) + F.col("event_id") % 3).cast("int"))).alias("target"), F.date_trunc("hour", ts).alias("pub"), F.floor(F.col("value") / 50).cast("double").alias("value"))


TIED = "v AS (SELECT event_type AS zone, date_trunc('day', ts) + (1 + event_id % 3) * INTERVAL 1 DAY AS target, date_trunc('hour', ts) AS pub, CAST(floor(value / 50) AS DOUBLE) AS value FROM events)"


@query(f"""WITH {TIED}, e AS (SELECT * FROM v WHERE {DEADLINE}), r AS (SELECT *, rank() OVER (PARTITION BY zone, target ORDER BY pub DESC) AS k FROM e)
SELECT zone, CAST(target AS TIMESTAMP) AS target, max(pub) AS pub, min(value) AS value, count(DISTINCT value) AS value_count, count(DISTINCT value) > 1 AS in_conflict FROM r WHERE k = 1 GROUP BY 1, 2""")
def asof_tie_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asof.latest_eligible(_tied(spark, sf_dir), ["zone", "target"], "pub", deadline(), ["value"])
    return found.select("zone", plain("target").alias("target"), plain("pub").alias("pub"), "value", "value_count", (F.col("value_count") > 1).alias("in_conflict"))


@query(f"""WITH {VINTAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY zone, target ORDER BY pub DESC, value) AS k FROM v)
SELECT zone, target, pub, value FROM r WHERE k = 1""")
def asof_latest_hindsight(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asof.latest_hindsight(vintages(spark, sf_dir), ["zone", "target"], "pub", "value")
    return found.select("zone", plain("target").alias("target"), plain("pub").alias("pub"), "value")


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast vintages: three publications on days before each hour; the model in use is every third event's other."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        (F.date_trunc("hour", ts) - T.hours((F.lit(20) + F.col("event_id") % 24).cast("int"))).alias("publication_ts_utc"),
        F.date_trunc("hour", ts).alias("target_ts_utc"), F.to_date(ts).alias("operating_date"), (F.hour(ts) + 1).alias("hour_ending"), F.lit("N").alias("dst_flag"),
        F.col("event_type").alias("weather_zone"), F.concat(F.lit("M"), (F.col("event_id") % 2).cast("string")).alias("model"), (F.col("event_id") % 3 > 0).alias("is_ercot_model_in_use"), (F.col("value") * 1.01).alias("forecast_mw"),
    )


def _actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        (ts + T.hours(30)).alias("publication_ts_utc"), F.date_trunc("hour", ts).alias("target_ts_utc"), F.to_date(ts).alias("operating_date"),
        (F.hour(ts) + 1).alias("hour_ending"), F.lit("N").alias("dst_flag"), F.col("event_type").alias("weather_zone"), F.col("value").alias("actual_mw"),
    )


ACTUALS = "a AS (SELECT ts + INTERVAL 30 HOUR AS pub, date_trunc('hour', ts) AS target, CAST(ts AS DATE) AS day, CAST(hour(ts) + 1 AS INTEGER) AS he, 'N' AS flag, event_type AS zone, value FROM events)"
FORECASTS = "f AS (SELECT date_trunc('hour', ts) - (20 + event_id % 24) * INTERVAL 1 HOUR AS pub, date_trunc('hour', ts) AS target, event_type AS zone, 'M' || (event_id % 2) AS model, event_id % 3 > 0 AS used, value * 1.01 AS value FROM events)"
START, END, SEEN = datetime(2024, 1, 9), datetime(2024, 1, 25), datetime(2024, 1, 26)


def _evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.evaluation_dataset(_forecasts(spark, sf_dir), _actuals(spark, sf_dir), asof.Params(START, END, SEEN))


NAIVE = """w AS (SELECT DISTINCT zone, target, day, he, flag FROM a WHERE target >= TIMESTAMP '2024-01-09' AND target < TIMESTAMP '2024-01-25'),
ne AS (SELECT w.zone, w.target, a.target AS source_ts, a.pub, a.value FROM w JOIN a ON a.zone = w.zone AND a.day = w.day - 7 AND a.he = w.he AND a.flag = w.flag WHERE a.pub <= w.target - INTERVAL 24 HOUR),
nl AS (SELECT zone, target, max(pub) AS pub FROM ne GROUP BY 1, 2),
n AS (SELECT nl.zone, nl.target, nl.pub, min(source_ts) AS source_ts, min(value) AS value, count(DISTINCT value) AS value_count FROM nl JOIN ne USING (zone, target, pub) GROUP BY 1, 2, 3)"""
EVALUATION = f"""{ACTUALS}, {FORECASTS}, {NAIVE},
fe AS (SELECT * FROM f WHERE used AND {DEADLINE}), fl AS (SELECT zone, target, max(pub) AS pub FROM fe GROUP BY 1, 2),
fa AS (SELECT fl.zone, fl.target, fl.pub, min(value) AS value, count(DISTINCT value) AS value_count, min(model) AS model, count(DISTINCT model) AS model_count FROM fl JOIN fe USING (zone, target, pub) GROUP BY 1, 2, 3),
ae AS (SELECT * FROM a WHERE pub <= TIMESTAMP '2024-01-26'), al AS (SELECT zone, target, max(pub) AS pub FROM ae GROUP BY 1, 2),
aa AS (SELECT al.zone, al.target, al.pub, min(value) AS value, count(DISTINCT value) AS value_count FROM al JOIN ae USING (zone, target, pub) GROUP BY 1, 2, 3),
ev AS (SELECT w.zone AS weather_zone, w.target AS target_ts_utc, w.day AS operating_date, w.he AS hour_ending, w.flag AS dst_flag, w.target - INTERVAL 24 HOUR AS cutoff_ts_utc,
fa.pub AS ercot_publication_ts_utc, fa.value AS ercot_forecast_mw, fa.model AS ercot_model, coalesce(fa.value_count, 0) AS ercot_value_count, coalesce(fa.model_count, 0) AS ercot_model_count,
date_diff('minute', fa.pub, w.target - INTERVAL 24 HOUR) / 60.0 AS ercot_vintage_age_hours, aa.pub AS actual_publication_ts_utc, aa.value AS actual_mw, coalesce(aa.value_count, 0) AS actual_value_count,
n.source_ts AS naive_source_ts_utc, n.pub AS naive_source_publication_ts_utc, n.value AS naive_forecast_mw, coalesce(n.value_count, 0) AS naive_value_count,
fa.value - aa.value AS ercot_error_mw, n.value - aa.value AS naive_error_mw
FROM w LEFT JOIN fa ON fa.zone = w.zone AND fa.target = w.target LEFT JOIN aa ON aa.zone = w.zone AND aa.target = w.target LEFT JOIN n ON n.zone = w.zone AND n.target = w.target)"""


@query(f"WITH {EVALUATION} SELECT * FROM ev")
def evaluation_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _evaluation(spark, sf_dir)
    return out.withColumns({c: plain(c) for c, t in out.dtypes if t == "timestamp"})


@query(f"WITH {ACTUALS}, {NAIVE} SELECT w.zone, w.target, n.source_ts, n.pub, n.value, coalesce(n.value_count, 0) AS value_count FROM w LEFT JOIN n USING (zone, target)")
def naive_calendar_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    actuals = _actuals(spark, sf_dir)
    wanted = asof.targets(actuals, F.lit(START), F.lit(END))
    key = ["weather_zone", "target_ts_utc"]
    found = asof.latest_eligible(asof.calendar_lag_candidates(wanted, actuals, 7, 24), key, "naive_source_publication_ts_utc", F.col("target_ts_utc") - T.hours(24), ["naive_source_ts_utc", "naive_forecast_mw"])
    out = wanted.select(*key).join(found, key, "left")
    return out.select(F.col("weather_zone").alias("zone"), plain("target_ts_utc").alias("target"), plain("naive_source_ts_utc").alias("source_ts"), plain("naive_source_publication_ts_utc").alias("pub"), F.col("naive_forecast_mw").alias("value"), F.coalesce("naive_forecast_mw_count", F.lit(0)).cast("bigint").alias("value_count"))


@query("""SELECT DISTINCT event_type AS zone, date_trunc('hour', ts) AS target, CAST(ts AS DATE) AS operating_date FROM events WHERE event_type <> 'view' AND ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-25'""")
def targets_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct target hours of a half-open window, without one pseudo-zone."""
    actuals = _actuals(spark, sf_dir).where("weather_zone <> 'view'")
    return asof.targets(actuals, F.lit(START), F.lit(END)).select(F.col("weather_zone").alias("zone"), plain("target_ts_utc").alias("target"), "operating_date")


# ---------------------------------------------------------------- functions


@query(f"WITH {VINTAGES} SELECT event_id, date_diff('minute', pub, target) / 60.0 AS age_hours FROM v")
def vintage_age_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vintages(spark, sf_dir).select("event_id", (T.minute_boundaries(F.col("pub"), F.col("target")) / 60.0).alias("age_hours"))


@query(f"WITH {VINTAGES} SELECT CAST(date_diff('minute', pub, target) / 60.0 AS INTEGER) AS lead_hours, count(*) AS n FROM v GROUP BY 1")
def lead_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vintages(spark, sf_dir).groupBy(T.lead_hours(F.col("pub"), F.col("target")).alias("lead_hours")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%MZ') AS minute, substr(sha256(CAST(event_id AS VARCHAR)), 1, 16) AS id16, md5(event_type || '|' || event_id) AS digest FROM events")
def keys_and_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select("event_id", T.iso_minute(F.col("ts")).alias("minute"), F.substring(F.sha2(number, 256), 1, 16).alias("id16"), F.md5(F.concat("event_type", F.lit("|"), number).cast("binary")).alias("digest"))


@query("""SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(date_diff('hour', timezone('America/Chicago', CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)), timezone('America/Chicago', CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP))) AS BIGINT) AS hours FROM orders""")
def expected_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of each order day in local hours, by listing them."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return T.expected_hours(days).groupBy("day").agg(F.count(F.lit(1)).alias("hours"))


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, h FROM orders, range(1, 25) r(h)),
w AS (SELECT day, CAST(h AS INTEGER) AS hour_ending, CAST(day AS TIMESTAMP) + (h - 1) * INTERVAL 1 HOUR AS wall FROM d),
u AS (SELECT *, timezone('America/Chicago', wall) AS late FROM w)
SELECT day, hour_ending, timezone('UTC', CASE WHEN timezone('America/Chicago', late) = wall THEN late END) AS target_ts,
coalesce(timezone('America/Chicago', late - INTERVAL 1 HOUR) = wall, false) AS is_repeated, CASE WHEN timezone('America/Chicago', late) <> wall THEN 'NONEXISTENT_LOCAL_HOUR' END AS error_code FROM u""")
def resolve_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    rows = days.select("day", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("hour_ending")).withColumn("r", T.resolve_hour(F.col("day"), F.col("hour_ending"), F.lit("N")))
    return rows.select("day", "hour_ending", plain("r.target_ts").alias("target_ts"), "r.is_repeated", "r.error_code")


@query("""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END AS text FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(text, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') THEN CAST(strptime(text, '%m/%d/%Y') AS DATE) END AS day,
CASE WHEN o_orderkey % 30 BETWEEN 1 AND 25 THEN CAST(o_orderkey % 30 AS INTEGER) END AS hour_ending, CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS dst_flag FROM t""")
def parse_local_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = F.when(key % 7 == 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    flag = F.when(key % 3 == 0, " y").when(key % 3 == 1, "N").otherwise("?")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.parse_operating_date(text).alias("day"), T.parse_hour_ending(F.concat((key % 30).cast("string"), F.lit(":00"))).alias("hour_ending"), T.parse_dst_flag(flag).alias("dst_flag"))


# ---------------------------------------------------------------- metrics


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted against listed prices of order lines: return flags as zones, ship days as operating days.

    A discount is net of a charge of 0.07 %, so that averages have no finite decimals and no engine rounds at a tie.
    """
    rows = table(spark, sf_dir, "lineitem")
    error = -F.col("l_extendedprice") * F.col("l_discount") / 1.0007
    return rows.select(F.col("l_returnflag").alias("weather_zone"), F.to_date("l_shipdate").alias("operating_date"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("target_ts_utc"), F.col("l_extendedprice").alias("actual_mw"), error.alias("error_mw"), F.abs(error).alias("abs_error_mw"))


SCORED = "s AS (SELECT l_returnflag AS weather_zone, CAST(l_shipdate AS DATE) AS operating_date, l_orderkey * 10 + l_linenumber AS target_ts_utc, l_extendedprice AS actual_mw, -l_extendedprice * l_discount / 1.0007::DOUBLE AS error_mw, abs(-l_extendedprice * l_discount / 1.0007::DOUBLE) AS abs_error_mw FROM lineitem)"
SUMMARY = "count(*) AS rows, round(100.0 * sum(abs_error_mw) / nullif(sum(actual_mw), 0), 7) AS wape_pct, round(avg(abs_error_mw), 7) AS mae_mw, round(avg(error_mw), 7) AS bias_mw, round(quantile_cont(100.0 * abs_error_mw / nullif(actual_mw, 0), 0.95), 7) AS p95_ape_pct"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 7) for c, t in df.dtypes if t == "double"})


@query(f"WITH {SCORED} SELECT {SUMMARY} FROM s")
def wape_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.summary(_scored(spark, sf_dir), []))


@query(f"WITH {SCORED} SELECT operating_date, {SUMMARY} FROM s GROUP BY 1")
def wape_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.summary(_scored(spark, sf_dir), ["operating_date"]))


@query(f"""WITH {SCORED}, p AS (SELECT *, row_number() OVER (PARTITION BY weather_zone, operating_date ORDER BY actual_mw DESC, target_ts_utc) AS k FROM s)
SELECT weather_zone, count(*) AS rows, round(100.0 * sum(abs_error_mw) / nullif(sum(actual_mw), 0), 7) AS wape_pct, round(max(abs_error_mw) FILTER (WHERE k = 1), 7) AS peak_hour_abs_error_mw, round(max(100.0 * abs_error_mw / nullif(actual_mw, 0)) FILTER (WHERE k = 1), 7) AS peak_hour_ape_pct FROM p GROUP BY 1""")
def zone_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.zone_scores(_scored(spark, sf_dir)))


@query("""SELECT event_type AS weather_zone, operating_date, event_id, value FROM (SELECT *, CAST(ts AS DATE) AS operating_date, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY value DESC, event_id) AS k FROM events) WHERE k = 1""")
def peak_hour_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("weather_zone"), F.to_date("ts").alias("operating_date"), F.col("event_id").alias("target_ts_utc"), "event_id", F.col("value").alias("actual_mw"))
    return metrics.peak_rows(rows).select("weather_zone", "operating_date", "event_id", F.col("actual_mw").alias("value"))


@query(f"WITH {EVALUATION} SELECT count(*) AS rows, round(max(ercot_vintage_age_hours), 3) AS max_age, " + ", ".join(f"count(*) FILTER (WHERE {test}) AS {code}" for code, test in (("MISSING_ASOF_FORECAST", "ercot_forecast_mw IS NULL"), ("MISSING_ACTUAL", "actual_mw IS NULL"), ("MISSING_NAIVE_INPUT", "naive_forecast_mw IS NULL"), ("CONFLICTING_ASOF_FORECAST", "ercot_value_count > 1"), ("CONFLICTING_ASOF_ACTUAL", "actual_value_count > 1"), ("CONFLICTING_NAIVE_INPUT", "naive_value_count > 1"), ("CUTOFF_VIOLATION", "ercot_publication_ts_utc > cutoff_ts_utc"), ("NAIVE_CUTOFF_VIOLATION", "naive_source_publication_ts_utc > cutoff_ts_utc"), ("STALE_FORECAST_VINTAGE", "ercot_vintage_age_hours > 2.0"))) + " FROM ev")
def readiness_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All row checks of the readiness gate in one aggregate."""
    return gates.check_counts(_evaluation(spark, sf_dir))


@query("WITH " + FORECASTS + " SELECT zone, target, pub, count(*) FILTER (WHERE used) AS in_use FROM f GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE used) <> 1")
def ambiguous_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gates.ambiguous_models(_forecasts(spark, sf_dir))
    return found.select(F.col("weather_zone").alias("zone"), plain("target_ts_utc").alias("target"), plain("publication_ts_utc").alias("pub"), "in_use")


# ---------------------------------------------------------------- reports


@query(f"""WITH {EVALUATION}, h AS (SELECT zone, target, value FROM (SELECT *, row_number() OVER (PARTITION BY zone, target ORDER BY pub DESC, value) AS k FROM f WHERE used) WHERE k = 1)
SELECT count(*) AS rows, round(100.0 * sum(abs(ercot_error_mw)) / sum(actual_mw), 7) AS asof_wape_pct, round(100.0 * sum(abs(h.value - actual_mw)) / sum(actual_mw), 7) AS hindsight_wape_pct FROM ev JOIN h ON h.zone = weather_zone AND h.target = target_ts_utc WHERE ercot_forecast_mw IS NOT NULL AND actual_mw IS NOT NULL""")
def cost_of_hindsight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error as of the deadline, and of the value published last."""
    key = ["weather_zone", "target_ts_utc"]
    latest = asof.latest_hindsight(_forecasts(spark, sf_dir).where("is_ercot_model_in_use"), key, "publication_ts_utc", "forecast_mw").select(*key, F.col("forecast_mw").alias("latest_mw"))
    rows = metrics.scored(_evaluation(spark, sf_dir), "ercot").join(latest, key)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.round(metrics.wape(), 7).alias("asof_wape_pct"), F.round(metrics.wape(F.abs(F.col("latest_mw") - F.col("actual_mw"))), 7).alias("hindsight_wape_pct"))


@query(f"WITH {VINTAGES}, m AS (SELECT zone, avg(value) AS mean FROM v GROUP BY 1) SELECT CAST(date_diff('minute', pub, target) / 60.0 AS INTEGER) AS lead_hours, count(*) AS rows, round(100.0 * sum(abs(value - mean)) / nullif(sum(mean), 0), 7) AS wape_pct FROM v JOIN m USING (zone) GROUP BY 1 HAVING count(*) >= 200")
def lead_time_wape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted error by lead hours, where there are at least 200 rows."""
    v = vintages(spark, sf_dir)
    rows = v.join(sent(v.groupBy("zone").agg(F.avg("value").alias("actual_mw"))), "zone").withColumn("abs_error_mw", F.abs(F.col("value") - F.col("actual_mw")))
    by_lead = rows.groupBy(T.lead_hours(F.col("pub"), F.col("target")).alias("lead_hours")).agg(F.count(F.lit(1)).alias("rows"), F.round(metrics.wape(), 7).alias("wape_pct"))
    return by_lead.where("rows >= 200")


@query(f"WITH {TIED}, k AS (SELECT zone, target, count(DISTINCT value) AS n, count(DISTINCT pub) AS pubs FROM v GROUP BY 1, 2) SELECT count(*) AS keys, round(100.0 * sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) / count(*), 7) AS revised_pct, count(*) FILTER (WHERE pubs > 1) AS republished FROM k")
def revision_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _tied(spark, sf_dir).groupBy("zone", "target").agg(F.count_distinct("value").alias("n"), F.count_distinct("pub").alias("pubs"))
    return keys.agg(F.count(F.lit(1)).alias("keys"), F.round(100.0 * F.count_if(F.col("n") > 1) / F.count(F.lit(1)), 7).alias("revised_pct"), F.count_if(F.col("pubs") > 1).alias("republished"))


@query("WITH " + FORECASTS + ", k AS (SELECT zone, target, count(DISTINCT model) AS models, count(DISTINCT model) FILTER (WHERE used) AS in_use, string_agg(DISTINCT model, ', ' ORDER BY model) AS names FROM f GROUP BY 1, 2) SELECT models, in_use, names, count(*) AS keys FROM k GROUP BY 1, 2, 3")
def models_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _forecasts(spark, sf_dir).groupBy("weather_zone", "target_ts_utc").agg(F.count_distinct("model").alias("models"), F.count_distinct(F.when(F.col("is_ercot_model_in_use"), F.col("model"))).alias("in_use"), F.array_join(F.sort_array(F.collect_set("model")), ", ").alias("names"))
    return keys.groupBy("models", "in_use", "names").agg(F.count(F.lit(1)).alias("keys"))


@query("""WITH g AS (SELECT event_type, ts, date_diff('minute', lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id), ts) AS gap FROM events)
SELECT event_type, count(*) AS n, min(ts) AS oldest, max(ts) AS newest, count(DISTINCT gap) AS gaps, CAST(max(gap) AS DOUBLE) AS longest FROM g GROUP BY 1""")
def cadence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication cadence: the span, and the distinct gaps in minutes."""
    rows = reports.with_previous(table(spark, sf_dir, "events").select("event_type", "ts"), "event_type", "ts").withColumn("gap", T.minute_boundaries(F.col("previous_ts"), F.col("ts")))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("oldest"), F.max("ts").alias("newest"), F.count_distinct("gap").alias("gaps"), F.max("gap").alias("longest"))


@query("""SELECT event_type, pub_day, min(target_day) = pub_day AS same_day FROM (SELECT event_type, CAST(timezone('America/Chicago', timezone('UTC', ts)) AS DATE) AS pub_day, CAST(timezone('America/Chicago', timezone('UTC', ts + (event_id % 5) * INTERVAL 1 HOUR)) AS DATE) AS target_day FROM events) GROUP BY 1, 2""")
def time_zone_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the earliest target day of each local publication day is that day."""
    ts = F.col("ts").cast("timestamp")
    local = lambda t: F.to_date(F.from_utc_timestamp(t, T.ZONE))
    rows = table(spark, sf_dir, "events").select("event_type", local(ts).alias("pub_day"), local(ts + T.hours((F.col("event_id") % 5).cast("int"))).alias("target_day"))
    return rows.groupBy("event_type", "pub_day").agg((F.min("target_day") == F.first("pub_day")).alias("same_day"))


HOURLY = """h AS (SELECT CAST(wall AS DATE) AS day, CAST(hour(wall) AS INTEGER) AS hour, count(*) AS held FROM (SELECT timezone('America/Chicago', timezone('UTC', ts)) AS wall FROM events) GROUP BY 1, 2),
s AS (SELECT min(day) AS first, max(day) AS last, CAST(sum(held) AS BIGINT) // ((max(day) - min(day) + 1) * 24) + 1 AS due FROM h),
i AS (SELECT timezone('America/Chicago', unnest(generate_series(timezone('America/Chicago', CAST(first AS TIMESTAMP)), timezone('America/Chicago', CAST(last + 1 AS TIMESTAMP)) - INTERVAL 1 HOUR, INTERVAL 1 HOUR))) AS wall, due FROM s),
x AS (SELECT CAST(wall AS DATE) AS day, CAST(hour(wall) AS INTEGER) AS hour, CAST(sum(due) AS BIGINT) AS expected FROM i GROUP BY 1, 2),
c AS (SELECT x.day, x.hour, x.expected, coalesce(h.held, 0) AS held, least(x.expected, coalesce(h.held, 0)) AS credited FROM x LEFT JOIN h USING (day, hour)),
d AS (SELECT day, CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(credited) AS BIGINT) AS held FROM c GROUP BY 1)"""


def _local(ts: str) -> Column:
    return F.from_utc_timestamp(F.col(ts).cast("timestamp"), T.ZONE)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a publication, from the first to the last local day; due in each hour is one more than the mean."""
    from hindcast.schemas import LOAD_FORECAST

    held = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("publication_ts_utc"))
    day = F.to_date(_local("publication_ts_utc"))
    span = held.agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count(F.lit(1)).alias("n")).first()  # one row
    n = (span["last"] - span["first"]).days + 1 if span["n"] else 0
    days = spark.range(n).select(F.date_add(F.lit(span["first"]), F.col("id").cast("int")).alias("day"))
    expected = cov.expected_publications(days, LOAD_FORECAST).withColumn("expected", F.col("expected") * (span["n"] // (max(n, 1) * 24) + 1))
    return cov.measure(held, expected)


@query(f"WITH {HOURLY} SELECT day, hour, CAST(expected AS BIGINT) AS expected, held, CAST(credited AS BIGINT) AS credited, CAST(expected - credited AS BIGINT) AS missing FROM c")
def coverage_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).select("day", "hour", "expected", "held", "credited", "missing")


@query(f"WITH {HOURLY}, l AS (SELECT day, CAST(sum(held) AS BIGINT) AS listed FROM h GROUP BY 1) SELECT day, expected, held, CASE WHEN listed IS NULL THEN 'unknown' WHEN listed <= held THEN 'never published' ELSE 'not retrieved' END AS cause FROM d LEFT JOIN l USING (day) WHERE held < expected")
def retrieval_gap_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why days are incomplete, where the archive lists all events of a day and only those due in their hour count."""
    listed = table(spark, sf_dir, "events").groupBy(F.to_date(_local("ts")).alias("day")).agg(F.count(F.lit(1)).alias("listed"))
    return cov.attribute_gaps(cov.by_day(_measured(spark, sf_dir)).select("day", "expected", "held"), listed).select("day", "expected", "held", "cause")


@query("""WITH h AS (SELECT timezone('America/Chicago', timezone('UTC', ts)) AS wall FROM events), s AS (SELECT CAST(min(wall) AS DATE) AS first, CAST(max(wall) AS DATE) AS last FROM h),
d AS (SELECT CAST(unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM s), c AS (SELECT CAST(wall AS DATE) AS day, count(*) AS held FROM h WHERE hour(wall) = 5 GROUP BY 1)
SELECT day, 5::INTEGER AS hour, 1::BIGINT AS expected, coalesce(held, 0) AS held, CASE WHEN held > 0 THEN 0 ELSE 1 END::BIGINT AS missing FROM d LEFT JOIN c USING (day)""")
def daily_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that is due once a day, at five: every event of that local hour as a publication."""
    from hindcast.schemas import ACTUAL_LOAD

    held = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("publication_ts_utc"))
    span = held.agg(F.min(F.to_date(_local("publication_ts_utc"))).alias("first"), F.max(F.to_date(_local("publication_ts_utc"))).alias("last")).first()
    days = spark.range((span["last"] - span["first"]).days + 1 if span["last"] else 0).select(F.date_add(F.lit(span["first"]), F.col("id").cast("int")).alias("day"))
    return cov.measure(held, cov.expected_publications(days, ACTUAL_LOAD)).select("day", "hour", "expected", "held", "missing")


@query("SELECT CAST(event_id AS VARCHAR) AS doc_id, date_trunc('second', ts) AS post_ts_utc, CASE WHEN event_id % 5 > 0 THEN event_type ELSE '' END AS friendly_name FROM events")
def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of an archive's listing, in the forms that it gives: local or with an offset, under either of two names."""
    n, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    form = "yyyy-MM-dd'T'HH:mm:ss"
    stamp = F.when(n % 2 == 0, F.date_format(_local("ts"), form)).when(n % 3 == 0, F.concat(F.date_format(ts, form), F.lit("Z"))).otherwise(F.concat(F.date_format(ts + T.hours(2), form), F.lit("+02:00")))
    name = F.when(n % 5 > 0, F.col("event_type"))  # a missing name is left out of the record
    one = F.to_json(F.struct(n.alias("docId"), stamp.alias("postDatetime"), name.alias("friendlyName")))
    other = F.to_json(F.struct(n.alias("docID"), F.lit("").alias("postDatetime"), stamp.alias("postDatetimeUTC"), name.alias("friendlyName")))
    found = archive.archive_entries(table(spark, sf_dir, "events").select(F.when(n % 7 == 0, other).otherwise(one).alias("record")))
    return found.withColumn("post_ts_utc", plain("post_ts_utc"))


@query("""WITH m AS (SELECT s_suppkey, s_name, unnest(CASE WHEN s_suppkey % 3 = 0 THEN [''] ELSE ['a.zip', 'b.zip'] END) AS member FROM supplier)
SELECT s_suppkey, member, CAST(unnest([2, 3]) AS BIGINT) AS row_number, unnest([s_name || '|' || member, s_name || '|second "line"']) AS fields FROM m""")
def payload_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of an archive, one a supplier: a zip with a csv, or a zip of such zips; unwrapped, read and split."""
    two = F.array(F.lit("a.zip"), F.lit("b.zip"))
    members = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit(""))).otherwise(two)
    payloads = table(spark, sf_dir, "supplier").select("s_suppkey", _packed("s_name", members).alias("payload"))
    files = archive.unwrap(payloads).withColumn("local_path", F.concat(F.col("s_suppkey").cast("string"), F.lit("/"), "member"))
    rows = lines(files).select(F.split("local_path", "/").alias("p"), "row_number", "fields")
    return rows.select(F.col("p")[0].cast("bigint").alias("s_suppkey"), F.col("p")[1].alias("member"), "row_number", F.array_join("fields", "|").alias("fields"))


@F.pandas_udf(BinaryType())
def _packed(name: pd.Series, members: pd.Series) -> pd.Series:
    """Zips as an archive serves them, for the query above."""

    def zipped(**files: bytes | str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for k, v in files.items():
                z.writestr(k, v)
        return out.getvalue()

    def payload(n: str, inside: list[str]) -> bytes:
        csvs = {m: zipped(**{"x.csv": f'name,member\n{n},{m}\n{n},"second ""line"""\n'}) for m in inside}
        return csvs[""] if "" in csvs else zipped(**csvs)

    return pd.Series([payload(n, list(m)) for n, m in zip(name, members, strict=True)])


@query(f"""WITH {HOURLY}, o AS (SELECT *, row_number() OVER (ORDER BY day, hour) AS n FROM c), m AS (SELECT *, n - row_number() OVER (ORDER BY day, hour) AS run FROM o WHERE expected > credited)
SELECT min(day) AS first_day, arg_min(hour, n) AS first_hour, max(day) AS last_day, arg_max(hour, n) AS last_hour, count(*) AS hours, CAST(sum(expected - credited) AS BIGINT) AS missing FROM m GROUP BY run""")
def gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of hours with fewer events than are due, over midnights."""
    return cov.gap_runs(_measured(spark, sf_dir))


@query(f"""WITH {VINTAGES}, d AS (SELECT zone, target, CAST(lead AS INTEGER) AS lead_hours FROM (SELECT DISTINCT zone, target FROM v), range(1, 49) r(lead)),
p AS (SELECT d.zone, d.target, lead_hours, max(pub) AS pub FROM d JOIN v USING (zone, target) WHERE pub <= target - lead_hours * INTERVAL 1 HOUR GROUP BY 1, 2, 3),
x AS (SELECT lead_hours, min(value) AS value, count(DISTINCT value) AS n FROM p JOIN v USING (zone, target, pub) GROUP BY zone, target, lead_hours)
SELECT d.lead_hours, count(*) AS keys, any_value(k.known) AS known, any_value(k.tied) AS tied, any_value(k.mean_value) AS mean_value FROM d
LEFT JOIN (SELECT lead_hours, count(*) AS known, count(*) FILTER (WHERE n > 1) AS tied, round(avg(value / 1.0007::DOUBLE), 7) AS mean_value FROM x GROUP BY 1) k USING (lead_hours) GROUP BY 1""")
def lead_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known 1 to 48 hours before each target: 48 deadlines a key in one pass."""
    v = vintages(spark, sf_dir)
    wanted = v.select("zone", "target").distinct().select("zone", "target", F.explode(F.sequence(F.lit(1), F.lit(48))).alias("lead_hours"))
    wanted = wanted.withColumn("deadline", F.col("target") - T.hours(F.col("lead_hours")))
    found = asof.at_deadlines(v, ["zone", "target"], "pub", "value", wanted, "deadline")
    known = F.col("pub").isNotNull()
    return found.groupBy("lead_hours").agg(F.count(F.lit(1)).alias("keys"), F.count_if(known).alias("known"), F.count_if(F.col("value_count") > 1).alias("tied"), F.round(F.avg(F.col("value") / 1.0007), 7).alias("mean_value"))


# ---------------------------------------------------------------- normalisation and relational forms


LEDGER = """b AS (SELECT l_orderkey, l_partkey % 3 AS model, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS l_linenumber, l_quantity AS q, l_quantity > 48 AS bad FROM lineitem),
g AS (SELECT *, first_value(q) OVER (PARTITION BY l_orderkey, model ORDER BY l_linenumber) AS first_q, min(l_linenumber) OVER (PARTITION BY l_orderkey, model) AS first_row FROM b WHERE NOT bad),
c AS (SELECT *, max(CASE WHEN q <> first_q THEN l_linenumber END) OVER (PARTITION BY l_orderkey, model) AS clash FROM g),
o AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = first_row AND clash IS NULL THEN 'ACCEPTED' WHEN l_linenumber = first_row OR q <> first_q THEN 'QUARANTINED_KEY_CONFLICT' ELSE 'DUPLICATE_IDENTICAL' END AS disposition FROM c UNION ALL SELECT l_orderkey, l_linenumber, 'QUARANTINED_INVALID_VALUE' FROM b WHERE bad)"""


#: Lines to a part: what a task sorts does not grow with the table.
PART_LINES = 125_000


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their place in their order. They are dealt once, as narrow rows, by the name of the file that they
    stand for: the classifier and joins by that name find them together. Parts grow in number with the table, not in size
    (its rows are counted from the footers of its files)."""
    rows = table(spark, sf_dir, "lineitem")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_LINES))
    dealt = rows.withColumn("local_path", F.col("l_orderkey").cast("string")).repartition(parts, "local_path")
    return dealt.withColumn("place", F.row_number().over(Window.partitionBy("local_path").orderBy("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")))


def _named(lines: DataFrame, *more: Column) -> DataFrame:
    """The files of some lines, under their own names: dealt by ``local_path`` alone, as the lines are."""
    path = F.col("local_path")
    return lines.select("local_path").distinct().select("local_path", path.alias("source_file_id"), path.alias("original_filename"), *more)


@query(f"WITH {LEDGER} SELECT disposition, count(*) AS rows, min(l_orderkey || ' row ' || l_linenumber) AS sample FROM o GROUP BY 1")
def ledger_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as source lines of their order's file, through the line classifier."""
    from hindcast.schemas import ACTUAL_LOAD

    row = _placed(spark, sf_dir).withColumn("l_linenumber", F.col("place"))
    model = F.col("l_partkey") % 3
    number = F.when(F.col("l_quantity") > 48, F.lit("-1")).otherwise(F.col("l_quantity").cast("string"))
    cells = [F.lit("01/02/2024"), F.concat((model + 1).cast("string"), F.lit(":00")), *[number] * len(ACTUAL_LOAD.zones), F.lit("N")]
    lines = row.select("local_path", F.lit(",".join(ACTUAL_LOAD.header)).alias("header"), F.col("l_linenumber").cast("bigint").alias("row_number"), F.lit("").alias("raw_line"), F.array(*cells).alias("fields"))
    told = normalize.classify(lines, ACTUAL_LOAD).select("disposition", F.col("local_path").alias("source_filename"), F.col("row_number").alias("source_row_number"))
    return normalize.disposition_counts(told, ["disposition"])


@query("""SELECT l_orderkey, l_linenumber, measure, value FROM (SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem) UNPIVOT (value FOR measure IN (quantity, price, discount, tax))""")
def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax"}
    return normalize.unpivot(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], names, "measure", "value")


@query("SELECT event_type, " + ", ".join(f"round(avg(value / 1.0007::DOUBLE) FILTER (WHERE hour(ts) = {h}), 7) AS h{h}" for h in range(24)) + " FROM events GROUP BY 1")
def heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone by hour; the hours are given, so no pass looks for them."""
    rows = table(spark, sf_dir, "events").withColumn("h", F.concat(F.lit("h"), F.hour("ts").cast("string")))
    return rows.groupBy("event_type").pivot("h", [f"h{h}" for h in range(24)]).agg(F.round(F.avg(F.col("value") / 1.0007), 7))


@query("""SELECT count(DISTINCT o_orderkey) AS orders, min(o_orderkey) AS sample FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R' AND l.l_quantity > 45)""")
def semi_join_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_file_id"), F.lit(1).alias("processing_date"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_file_id"), F.lit(1).alias("processing_date"), F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), "QUARANTINED_SCHEMA_ERROR").otherwise("ACCEPTED").alias("disposition"))
    return gates.drifted_files(orders, lines).agg(F.count_distinct("source_file_id").alias("orders"), F.min("source_file_id").alias("sample"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE (l_orderkey, l_extendedprice) IN (SELECT l_orderkey, max(l_extendedprice) FROM lineitem GROUP BY 1)")
def tuple_in_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.join(rows.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("l_extendedprice")), ["l_orderkey", "l_extendedprice"], "left_semi").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT event_type, ts, value FROM events WHERE value = (SELECT max(value) FROM events)")
def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT event_type, ts, value FROM {e} WHERE value = (SELECT max(value) FROM {e})", e=table(spark, sf_dir, "events"))


@query("SELECT substr(sha256(string_agg(h, '' ORDER BY h)), 1, 32) AS run_id FROM (SELECT sha256(CAST(c_custkey AS VARCHAR)) AS h FROM customer)")
def run_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's identity: a hash of its files' sorted hashes."""
    files = table(spark, sf_dir, "customer").select(F.sha2(F.col("c_custkey").cast("string"), 256).alias("h"))
    return files.agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256), 1, 32).alias("run_id"))


@query("SELECT n_nationkey, md5(string_agg(r, '|' ORDER BY r)) AS digest FROM (SELECT c_nationkey AS n_nationkey, concat_ws(chr(31), c_custkey, c_name, c_mktsegment) AS r FROM customer) GROUP BY 1")
def table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_digest(table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), ["c_custkey", "c_name", "c_mktsegment"], ["n_nationkey"])


@query("SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 5")
def topk_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value").orderBy(F.col("value").desc(), "event_id").limit(5)


@query(f"""WITH {VINTAGES}, m AS (SELECT * FROM v WHERE target = (SELECT max(target) FROM v)) SELECT zone, count(*) AS ever_published, count(*) FILTER (WHERE {DEADLINE}) AS eligible FROM m GROUP BY 1""")
def published_and_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the last target: what was ever published, and what by its deadline."""
    v = vintages(spark, sf_dir)
    last = F.broadcast(v.agg(F.max("target").alias("target")))  # one row
    return v.join(last, "target").groupBy("zone").agg(F.count(F.lit(1)).alias("ever_published"), F.count_if(F.col("pub") <= deadline()).alias("eligible"))


@query(f"WITH {VINTAGES} SELECT zone, target, pub, value, {DEADLINE} AS eligible FROM v WHERE target = (SELECT max(target) FROM v) OR target = (SELECT min(target) FROM v)")
def forecast_fan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All publications of two targets, with whether each was eligible."""
    v = vintages(spark, sf_dir)
    ends = v.agg(F.array(F.max("target"), F.min("target")).alias("t")).select(F.explode("t").alias("target"))
    rows = v.join(F.broadcast(ends.distinct()), "target")
    return rows.select("zone", plain("target").alias("target"), plain("pub").alias("pub"), "value", (F.col("pub") <= deadline()).alias("eligible"))


@query(f"WITH {EVALUATION} SELECT operating_date, hour_ending, dst_flag, count(*) FILTER (WHERE naive_forecast_mw IS NULL) AS missing_naive, count(*) FILTER (WHERE ercot_vintage_age_hours > 2.0) AS stale FROM ev GROUP BY 1, 2, 3")
def gaps_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing naive inputs and stale forecasts by day, hour and flag."""
    return _evaluation(spark, sf_dir).groupBy("operating_date", "hour_ending", "dst_flag").agg(F.count_if(F.col("naive_forecast_mw").isNull()).alias("missing_naive"), F.count_if(F.col("ercot_vintage_age_hours") > 2.0).alias("stale"))


@query("""WITH s AS (SELECT event_type, ts, value, avg(value) OVER (PARTITION BY event_type) AS mean, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY value DESC, event_id) = 1 AS is_peak FROM events)
SELECT event_type, ts, round(100.0 * abs(value - mean) / nullif(value, 0), 7) AS ape_pct, is_peak FROM s""")
def ape_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The absolute percentage error of each row, flagged at each day's peak."""
    events = table(spark, sf_dir, "events")
    means = sent(events.groupBy("event_type").agg(F.avg("value").alias("mean")))
    peak = F.row_number().over(Window.partitionBy("event_type", F.to_date("ts")).orderBy(F.col("value").desc(), "event_id")) == 1
    rows = events.withColumn("is_peak", peak).join(means, "event_type")
    return rows.select("event_type", "ts", F.round(metrics.ape(F.abs(F.col("value") - F.col("mean")), F.col("value")), 7).alias("ape_pct"), "is_peak")


@query(f"WITH {EVALUATION} SELECT target_ts_utc, actual_mw, ercot_forecast_mw, naive_forecast_mw FROM ev WHERE weather_zone = 'click' ORDER BY 1")
def zone_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.zone_series(_evaluation(spark, sf_dir), "click").withColumn("target_ts_utc", plain("target_ts_utc"))


@query(f"WITH {ACTUALS} SELECT DISTINCT he AS hour_ending, flag AS dst_flag FROM a WHERE day = DATE '2024-01-10' ORDER BY 1, 2")
def reported_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reported_hours(_actuals(spark, sf_dir), date(2024, 1, 10))


@query(f"WITH {EVALUATION} SELECT weather_zone, operating_date, hour_ending, dst_flag, ercot_model, ercot_forecast_mw, actual_mw, naive_forecast_mw, ercot_error_mw, naive_error_mw, ercot_vintage_age_hours FROM ev WHERE weather_zone = 'click' AND operating_date = DATE '2024-01-12' AND hour_ending = 9")
def evaluation_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.evaluation_row(_evaluation(spark, sf_dir), "click", date(2024, 1, 12), 9)


@query(f"WITH {EVALUATION} SELECT weather_zone, target_ts_utc, actual_mw FROM ev WHERE actual_mw IS NOT NULL ORDER BY actual_mw DESC, target_ts_utc, weather_zone LIMIT 1")
def highest_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.highest_actual(_evaluation(spark, sf_dir)).withColumn("target_ts_utc", plain("target_ts_utc"))


@query(f"WITH {EVALUATION} SELECT weather_zone, hour_ending, round(100.0 * sum(abs(naive_error_mw)) / nullif(sum(actual_mw), 0), 7) AS wape_pct FROM ev WHERE naive_error_mw IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5")
def worst_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_cells(_evaluation(spark, sf_dir), "naive")


@query(f"""WITH {EVALUATION}, naive AS (SELECT operating_date, round(100.0 * sum(abs(naive_error_mw)) / nullif(sum(actual_mw), 0), 7) AS naive_wape_pct FROM ev WHERE naive_error_mw IS NOT NULL GROUP BY 1),
used AS (SELECT operating_date, round(100.0 * sum(abs(ercot_error_mw)) / nullif(sum(actual_mw), 0), 7) AS ercot_wape_pct FROM ev WHERE ercot_error_mw IS NOT NULL GROUP BY 1) SELECT operating_date, naive_wape_pct, ercot_wape_pct FROM naive FULL JOIN used USING (operating_date)""")
def folds_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.folds_side_by_side(_evaluation(spark, sf_dir))


@query(f"WITH {VINTAGES} SELECT zone, count(*) AS rows, round(avg(CASE WHEN {DEADLINE} THEN 1.0::DOUBLE ELSE 0 END), 7) AS eligible_share FROM v GROUP BY 1")
def eligible_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many vintages of each zone were published by their deadline."""
    share = F.round(F.avg((F.col("pub") <= deadline()).cast("double")), 7)
    return vintages(spark, sf_dir).groupBy("zone").agg(F.count(F.lit(1)).alias("rows"), share.alias("eligible_share"))


FAULTS = """b AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS place FROM lineitem),
o AS (SELECT l_orderkey, place, CASE WHEN l_orderkey % 20 = 0 THEN 'SCHEMA_DRIFT' WHEN place > 23 THEN 'INVALID_HOUR_ENDING' WHEN (l_orderkey + place) % 12 < 9 THEN
['FIELD_COUNT_MISMATCH', 'INVALID_OPERATING_DATE', 'INVALID_HOUR_ENDING', 'INVALID_DST_FLAG', 'UNEXPECTED_DST_FLAG', 'NONEXISTENT_LOCAL_HOUR', 'UNPARSEABLE_MW', 'NON_FINITE_MW', 'IMPLAUSIBLE_MW'][(l_orderkey + place) % 12 + 1] END AS reason_code FROM b)"""


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as source lines of their order's file, most of them with one fault."""
    from hindcast.schemas import ACTUAL_LOAD

    rows = _placed(spark, sf_dir)
    k = F.when(F.col("place") > 23, 2).otherwise((F.col("l_orderkey") + F.col("place")) % 12)
    day = F.when(k == 1, "1/02/2024").when(k == 5, "03/10/2024").otherwise("01/02/2024")
    hour = F.when(k == 2, "26:00").when(k == 5, "3:00").otherwise(F.concat(F.col("place").cast("string"), F.lit(":00")))
    flag = F.when(k == 3, "?").when(k == 4, "Y").otherwise("N")
    mw = F.when(k == 6, "abc").when(k == 7, "inf").when(k == 8, "200001").otherwise("100.5")
    cells = F.array(day, hour, *[mw] * len(ACTUAL_LOAD.zones), flag)
    header = ",".join(ACTUAL_LOAD.header)
    return rows.select("local_path", F.when(F.col("l_orderkey") % 20 == 0, header + ",X").otherwise(header).alias("header"), F.col("place").cast("bigint").alias("row_number"), F.lit("").alias("raw_line"), F.when(k == 0, F.slice(cells, 1, 5)).otherwise(cells).alias("fields"))


@query(f"WITH {FAULTS} SELECT CASE WHEN reason_code IS NULL THEN 'ACCEPTED' WHEN reason_code = 'SCHEMA_DRIFT' THEN 'QUARANTINED_SCHEMA_ERROR' WHEN reason_code LIKE '%_MW' THEN 'QUARANTINED_INVALID_VALUE' ELSE 'QUARANTINED_PARSE_ERROR' END AS disposition, reason_code, count(*) AS rows, min(l_orderkey || ' row ' || place) AS sample FROM o GROUP BY 1, 2")
def ledger_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger by disposition and reason, with every fault that a line of actuals can have by itself."""
    from hindcast.schemas import ACTUAL_LOAD

    told = normalize.classify(_faulty(spark, sf_dir), ACTUAL_LOAD)
    return normalize.disposition_counts(told.withColumnsRenamed({"local_path": "source_filename", "row_number": "source_row_number"}), ["disposition", "reason_code"])


@query(f"WITH {FAULTS} SELECT CAST(l_orderkey AS VARCHAR) AS source_file_id, CAST(place AS BIGINT) AS source_row_number, DATE '2024-01-02' AS operating_date, CAST(place AS INTEGER) AS hour_ending, TIMESTAMP '2024-01-02 06:00:00' + (place - 1) * INTERVAL 1 HOUR AS target_ts_utc, unnest(['COAST', 'EAST', 'FAR_WEST', 'NORTH', 'NORTH_CENTRAL', 'SOUTHERN', 'SOUTH_CENTRAL', 'WEST', 'SYSTEM_TOTAL']) AS weather_zone, 100.5::DOUBLE AS actual_mw FROM o WHERE reason_code IS NULL")
def observations_of_accepted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hindcast.schemas import ACTUAL_LOAD

    lines = _faulty(spark, sf_dir)
    rows = normalize.observations(normalize.classify(lines, ACTUAL_LOAD), _named(lines, F.lit(START).alias("publication_ts_utc")), ACTUAL_LOAD)
    return rows.select("source_file_id", "source_row_number", "operating_date", "hour_ending", plain("target_ts_utc").alias("target_ts_utc"), "weather_zone", "actual_mw")


@query(f"WITH {FAULTS} SELECT CAST(l_orderkey AS VARCHAR) AS local_path, count(*) AS raw_row_count, l_orderkey % 20 = 0 AS drifted FROM o GROUP BY l_orderkey")
def file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of each file, and whether its header's fingerprint is another than the report's."""
    from hindcast.schemas import ACTUAL_LOAD

    facts = normalize.file_facts(_faulty(spark, sf_dir))
    return facts.select("local_path", "raw_row_count", (F.col("schema_fingerprint") != normalize.fingerprint(F.lit(",".join(ACTUAL_LOAD.header)))).alias("drifted"))


@query(f"""WITH {EVALUATION}, s AS (SELECT * FROM ev WHERE naive_error_mw IS NOT NULL), folds AS (SELECT 100.0 * sum(abs(naive_error_mw)) / nullif(sum(actual_mw), 0) AS w FROM s GROUP BY operating_date),
peaks AS (SELECT weather_zone, max(100.0 * abs(naive_error_mw) / nullif(actual_mw, 0)) AS w FROM (SELECT *, row_number() OVER (PARTITION BY weather_zone, operating_date ORDER BY actual_mw DESC, target_ts_utc) AS k FROM s) WHERE k = 1 GROUP BY 1),
r AS (SELECT 'INCOMPLETE_SCORING' AS code, (SELECT count(*) FROM ev) - (SELECT count(*) FROM s) AS n UNION ALL SELECT 'WAPE_ABOVE_THRESHOLD', count(*) FROM (SELECT 100.0 * sum(abs(naive_error_mw)) / sum(actual_mw) AS w FROM s) WHERE w > 8
UNION ALL SELECT 'FOLD_WAPE_ABOVE_THRESHOLD', count(*) FROM folds WHERE w IS NULL OR w > 9 UNION ALL SELECT 'PEAK_HOUR_ERROR_ABOVE_THRESHOLD', count(*) FROM peaks WHERE w > 20) SELECT code, CAST(n AS BIGINT) AS n FROM r WHERE n > 0""")
def model_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model gate's verdict as rows; there is a reason for each kind of failure, so a handful."""
    found = gates.model_gate(_evaluation(spark, sf_dir), "run", date(2024, 1, 26))
    return spark.createDataFrame([(r.code, r.count) for r in found.reasons], "code string, n bigint")


# ---------------------------------------------------------------- the whole readiness gate, and further forms


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, h, flag FROM orders, range(1, 26) r(h), (VALUES ('Y'), ('N')) f(flag)),
w AS (SELECT day, CAST(h AS INTEGER) AS hour_ending, flag AS dst_flag, CAST(day AS TIMESTAMP) + (h - 1) * INTERVAL 1 HOUR AS wall FROM d),
u AS (SELECT *, timezone('America/Chicago', wall) AS late FROM w), t AS (SELECT *, timezone('America/Chicago', late) = wall AS real, timezone('America/Chicago', late - INTERVAL 1 HOUR) = wall AS twice FROM u)
SELECT day, hour_ending, dst_flag, timezone('UTC', CASE WHEN real AND dst_flag = 'N' THEN late WHEN real AND twice THEN late - INTERVAL 1 HOUR END) AS target_ts, real AND twice AS is_repeated,
CASE WHEN NOT real THEN 'NONEXISTENT_LOCAL_HOUR' WHEN dst_flag = 'Y' AND NOT twice THEN 'UNEXPECTED_DST_FLAG' END AS error_code FROM t""")
def resolve_flagged_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours 1 to 25 of each order day, with either flag."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    rows = days.select("day", F.explode(F.sequence(F.lit(1), F.lit(25))).alias("hour_ending")).select("*", F.explode(F.array(F.lit("Y"), F.lit("N"))).alias("dst_flag"))
    rows = rows.withColumn("r", T.resolve_hour(F.col("day"), F.col("hour_ending"), F.col("dst_flag")))
    return rows.select("day", "hour_ending", "dst_flag", plain("r.target_ts").alias("target_ts"), "r.is_repeated", "r.error_code")


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), l AS (SELECT day, date_diff('hour', timezone('America/Chicago', CAST(day AS TIMESTAMP)), timezone('America/Chicago', CAST(day + 1 AS TIMESTAMP))) AS hours FROM d)
SELECT CAST(month(day) AS INTEGER) AS month, count(*) FILTER (WHERE hours = 23) AS spring, count(*) FILTER (WHERE hours = 24) AS ordinary, count(*) FILTER (WHERE hours = 25) AS autumn FROM l GROUP BY 1""")
def days_by_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many order days of each month have 23, 24 and 25 hours."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    kind = F.when(T.hours_in_day(F.col("day")) == 23, "spring").when(T.hours_in_day(F.col("day")) == 25, "autumn").otherwise("ordinary")
    rows = days.select(F.month("day").alias("month"), kind.alias("kind"))
    return rows.groupBy("month").pivot("kind", ["spring", "ordinary", "autumn"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS k FROM events) WHERE k = 1")
def zone_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.zone_peak(table(spark, sf_dir, "events").select("event_type", "event_id", "value"), "event_type", "value", "event_id")


@query("SELECT DISTINCT date_trunc('minute', ts) AS ts FROM events ORDER BY 1 DESC LIMIT 10")
def newest_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("ts"))
    return reports.newest(rows, "ts", 10).withColumn("ts", plain("ts"))


@query("""WITH r AS (SELECT md5(concat_ws(chr(31), c_custkey, c_name, c_mktsegment)) AS h FROM customer) SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS VARCHAR) AS digest FROM r""")
def portable_table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of a whole table that gathers no rows."""
    return portable_digest(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@query(f"WITH {EVALUATION} SELECT target_ts_utc, weather_zone, actual_mw, naive_error_mw FROM ev ORDER BY 1, 2")
def evaluation_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = asof.in_order(_evaluation(spark, sf_dir))
    return rows.select(plain("target_ts_utc").alias("target_ts_utc"), "weather_zone", "actual_mw", "naive_error_mw")


FORECAST_FAULTS = """p AS (SELECT l_orderkey, place, place % 2 = 1 AS used, CASE WHEN place > 23 THEN 'INVALID_HOUR_ENDING' WHEN (l_orderkey + place) % 8 = 0 THEN 'INVALID_IN_USE_FLAG' WHEN (l_orderkey + place) % 8 = 1 THEN 'MISSING_MODEL'
WHEN (l_orderkey + place) % 8 = 2 THEN 'IMPLAUSIBLE_MW' END AS reason_code FROM b)"""
DISPOSITION = "CASE WHEN reason_code IS NULL THEN 'ACCEPTED' WHEN reason_code = 'SCHEMA_DRIFT' THEN 'QUARANTINED_SCHEMA_ERROR' WHEN reason_code LIKE '%_MW' OR reason_code IN ('INVALID_IN_USE_FLAG', 'MISSING_MODEL') THEN 'QUARANTINED_INVALID_VALUE' ELSE 'QUARANTINED_PARSE_ERROR' END"


def _faulty_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same order lines as lines of forecast files."""
    from hindcast.schemas import LOAD_FORECAST

    rows = _placed(spark, sf_dir)
    k = (F.col("l_orderkey") + F.col("place")) % 8
    hour = F.concat(F.when(F.col("place") > 23, 26).otherwise(F.col("place")).cast("string"), F.lit(":00"))
    use = F.when(k == 0, "?").when(F.col("place") % 2 == 1, "Y").otherwise("n")
    mw = F.when(k == 2, "-3").otherwise("100.5")
    cells = F.array(F.lit("01/02/2024"), hour, *[mw] * len(LOAD_FORECAST.zones), F.when(k == 1, " ").otherwise("M"), use, F.lit("N"))
    return rows.select("local_path", F.lit(",".join(LOAD_FORECAST.header)).alias("header"), F.col("place").cast("bigint").alias("row_number"), F.lit("").alias("raw_line"), cells.alias("fields"))


def _ledger(lines: DataFrame, report) -> DataFrame:
    return normalize.ledger(normalize.classify(lines, report), _named(lines, F.lit(report.key).alias("report_key")))


@query(f"WITH {FAULTS}, {FORECAST_FAULTS}, r AS (SELECT 'actual_load' AS report_key, l_orderkey, place, reason_code FROM o UNION ALL SELECT 'load_forecast', l_orderkey, place, reason_code FROM p) SELECT report_key, {DISPOSITION} AS disposition, reason_code, count(*) AS rows, min(l_orderkey || ' row ' || place) AS sample FROM r GROUP BY 1, 2, 3")
def ledger_by_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of both reports, by report, disposition and reason."""
    from hindcast.schemas import ACTUAL_LOAD, LOAD_FORECAST

    both = _ledger(_faulty(spark, sf_dir), ACTUAL_LOAD).unionByName(_ledger(_faulty_forecasts(spark, sf_dir), LOAD_FORECAST))
    return normalize.disposition_counts(both, ["report_key", "disposition", "reason_code"])


@query(f"WITH {FAULTS}, {FORECAST_FAULTS} SELECT CAST(l_orderkey AS VARCHAR) AS source_file_id, CAST(place AS BIGINT) AS source_row_number, CAST(place AS INTEGER) AS hour_ending, unnest(['COAST', 'EAST', 'FAR_WEST', 'NORTH', 'NORTH_CENTRAL', 'SOUTHERN', 'SOUTH_CENTRAL', 'WEST', 'SYSTEM_TOTAL']) AS weather_zone, 'M' AS model, used AS is_ercot_model_in_use, 100.5::DOUBLE AS forecast_mw FROM p WHERE reason_code IS NULL")
def observations_of_forecast_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hindcast.schemas import LOAD_FORECAST

    lines = _faulty_forecasts(spark, sf_dir)
    rows = normalize.observations(normalize.classify(lines, LOAD_FORECAST), _named(lines, F.lit(START).alias("publication_ts_utc")), LOAD_FORECAST)
    return rows.select("source_file_id", "source_row_number", "hour_ending", "weather_zone", "model", "is_ercot_model_in_use", "forecast_mw")


def _miscounted(lines: DataFrame) -> DataFrame:
    """File facts of which every seventh file claims one line more than it has."""
    more = F.when(F.col("local_path").cast("bigint") % 7 == 0, 1).otherwise(0)
    return normalize.file_facts(lines).withColumn("raw_row_count", F.col("raw_row_count") + more)


@query(f"WITH {FAULTS} SELECT CAST(l_orderkey AS VARCHAR) AS local_path, count(*) + 1 AS raw_row_count, count(*) AS dispositions FROM o WHERE l_orderkey % 7 = 0 GROUP BY l_orderkey")
def unaccounted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hindcast.schemas import ACTUAL_LOAD

    lines = _faulty(spark, sf_dir)
    return normalize.unaccounted(_miscounted(lines), normalize.classify(lines, ACTUAL_LOAD))


def _readiness(spark: SparkSession, sf_dir: str) -> gates.GateResult:
    """The readiness gate over a ledger with faults, miscounted files and the evaluation dataset.

    The gate reads its tables several times, as those of a run are written before it. Here the ledger's columns that it
    uses and the evaluation's rows (hours by zones) are kept on the executors' disks meanwhile, so each is made once."""
    from hindcast.plans.run import expected_rows
    from hindcast.schemas import ACTUAL_LOAD

    day, first, last = date(2024, 1, 26), date(2024, 1, 9), date(2024, 1, 24)
    lines, of_day = _faulty(spark, sf_dir), {"processing_date": F.lit(day)}
    files = _miscounted(lines).select("raw_row_count", F.col("local_path").alias("source_file_id"), F.col("local_path").alias("original_filename"))
    told = _ledger(lines, ACTUAL_LOAD).select("source_file_id", "source_filename", "source_row_number", "disposition", "reason_code").persist(StorageLevel.DISK_ONLY)
    evaluation = _evaluation(spark, sf_dir).persist(StorageLevel.DISK_ONLY)
    tables = {"source_file": files.withColumns(of_day), "source_row": told.withColumns(of_day), "forecast_vintage": _forecasts(spark, sf_dir), "actual_vintage": _actuals(spark, sf_dir)}
    try:
        return gates.readiness(tables, evaluation, expected_rows(spark, first, last), "run", day, (first, last))
    finally:
        told.unpersist()
        evaluation.unpersist()


ROW_CHECKS = {"MISSING_ASOF_FORECAST": "ercot_forecast_mw IS NULL", "MISSING_ACTUAL": "actual_mw IS NULL", "MISSING_NAIVE_INPUT": "naive_forecast_mw IS NULL", "CONFLICTING_ASOF_FORECAST": "ercot_value_count > 1", "CONFLICTING_ASOF_ACTUAL": "actual_value_count > 1", "CONFLICTING_NAIVE_INPUT": "naive_value_count > 1", "CUTOFF_VIOLATION": "ercot_publication_ts_utc > cutoff_ts_utc", "NAIVE_CUTOFF_VIOLATION": "naive_source_publication_ts_utc > cutoff_ts_utc", "STALE_FORECAST_VINTAGE": "ercot_vintage_age_hours > 2.0"}


@query(f"""WITH {FAULTS}, {EVALUATION}, r AS (SELECT 'SOURCE_ROWS_UNACCOUNTED' AS code, count(DISTINCT l_orderkey) AS n FROM o WHERE l_orderkey % 7 = 0
UNION ALL SELECT 'QUARANTINED_' || reason_code, count(*) FROM o WHERE reason_code IS NOT NULL GROUP BY 1 UNION ALL SELECT 'SCHEMA_DRIFT', count(DISTINCT l_orderkey) FROM o WHERE l_orderkey % 20 = 0
UNION ALL SELECT 'AMBIGUOUS_MODEL_IN_USE', count(*) FROM (SELECT 1 FROM f GROUP BY zone, target, pub HAVING count(*) FILTER (WHERE used) <> 1)
UNION ALL SELECT 'INCOMPLETE_ZONE_HOUR_COVERAGE', abs(16 * 24 * 8 - count(*)) FROM ev """ + " ".join(f"UNION ALL SELECT '{code}', count(*) FROM ev WHERE {test}" for code, test in ROW_CHECKS.items()) + ") SELECT code, CAST(n AS BIGINT) AS n FROM r WHERE n > 0")
def readiness_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readiness gate's verdict as rows: at most one for each kind of reason."""
    return spark.createDataFrame([(r.code, r.count) for r in _readiness(spark, sf_dir).reasons], "code string, n bigint")


@query(f"""WITH {FAULTS}, {EVALUATION} SELECT 'FAIL' AS status, (SELECT count(DISTINCT l_orderkey) FROM o) AS source_files, (SELECT count(*) FROM o) + (SELECT count(DISTINCT l_orderkey) FROM o WHERE l_orderkey % 7 = 0) AS raw_source_rows, (SELECT count(*) FROM o) AS ledger_rows,
(SELECT count(*) FROM f) AS forecast_observations, (SELECT count(*) FROM a) AS actual_observations, (SELECT count(*) FROM ev) AS evaluation_rows, CAST(16 * 24 * 8 AS BIGINT) AS expected_evaluation_rows, (SELECT round(max(ercot_vintage_age_hours), 3) FROM ev) AS max_forecast_vintage_age_hours""")
def readiness_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readiness gate's metrics: one row."""
    found = json.loads(_readiness(spark, sf_dir).to_json())
    kinds = {"source_files": "bigint", "raw_source_rows": "bigint", "ledger_rows": "bigint", "forecast_observations": "bigint", "actual_observations": "bigint", "evaluation_rows": "bigint", "expected_evaluation_rows": "bigint", "max_forecast_vintage_age_hours": "double"}
    return spark.createDataFrame([(found["status"], *[found["metrics"][k] for k in kinds])], "status string, " + ", ".join(f"{k} {t}" for k, t in kinds.items()))


# ---------------------------------------------------------------- digests


def _merkle_sql(name: str, rows: str) -> str:
    levels = [f"{name}3 AS (SELECT leaf AS prefix, count(*) AS rows, md5(string_agg(d, '' ORDER BY d)) AS digest FROM ({rows}) GROUP BY 1)"]
    levels += [f"{name}{n} AS (SELECT substr(prefix, 1, {n}) AS prefix, CAST(sum(rows) AS BIGINT) AS rows, md5(string_agg(prefix || digest, '' ORDER BY prefix)) AS digest FROM {name}{n + 1} GROUP BY 1)" for n in (2, 1, 0)]
    return ", ".join(levels)


ORDER_ROWS = "SELECT substr(md5('=' || o_orderkey), 1, 3) AS leaf, md5('=' || o_orderkey || chr(31) || '=' || o_custkey || chr(31) || '=' || {status} || chr(31) || '=' || o_orderpriority) AS d FROM orders"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("WITH " + _merkle_sql("l", ORDER_ROWS.format(status="o_orderstatus")) + " SELECT * FROM l3 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l0")
def merkle_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of all orders as a tree of three digits."""
    return merkle.tree(table(spark, sf_dir, "orders"), ["o_orderkey"], ORDER_COLUMNS, 3)


@query("WITH " + _merkle_sql("l", ORDER_ROWS.format(status="o_orderstatus")) + ", " + _merkle_sql("r", ORDER_ROWS.format(status="CASE WHEN o_orderkey % 1000 = 7 THEN 'X' ELSE o_orderstatus END")) + " SELECT prefix, l3.rows AS left_rows, r3.rows AS right_rows FROM l3 FULL JOIN r3 USING (prefix) WHERE l3.digest IS DISTINCT FROM r3.digest")
def merkle_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves in which the orders differ from their copy with some other states."""
    orders = table(spark, sf_dir, "orders")
    other = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 1000 == 7, "X").otherwise(F.col("o_orderstatus")))
    return merkle.differences(*[merkle.tree(x, ["o_orderkey"], ORDER_COLUMNS, 3) for x in (orders, other)])
