"""Wide source lines to long observations, with exactly one disposition for each line.

Checks form one chain of which the first failure wins. Lines of one file that share a key are compared with the first
of them behind one exchange: equal ones are duplicates, different ones are conflicts, and a conflict retracts the first line
too. Nothing is guessed: what is not accepted is in the ledger with its reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast import schemas as S
from hindcast.functions import time as T
from hindcast.schemas import Report

MIN_MW, MAX_MW = 0.0, 200_000.0
_NUMBER = r"^\s*[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?\s*$"
#: What nearly all values look like: none of them is below MIN_MW, and all are of finite length.
_PLAIN = r"[0-9]{1,6}(?:\.[0-9]{1,12})?"
_NOT_FINITE = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"


def fingerprint(header: Column) -> Column:
    return F.substring(F.sha2(header, 256), 1, 16)


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), F.regexp_replace(F.trim(text), "_", "").try_cast("double"))


def _plausible(number: Column) -> Column:
    return F.coalesce(number.between(MIN_MW, MAX_MW), F.lit(False))


def _checked(name: Column, text: Column, number: Column) -> Column:
    """A zone's name and text with what is wrong with its value, which is not plausible."""
    infinite = F.coalesce(text.rlike(_NOT_FINITE), F.lit(False)) | F.coalesce(F.abs(number) == float("inf"), F.lit(False))
    code = F.when(infinite, "NON_FINITE_MW").when(number.isNull(), "UNPARSEABLE_MW").otherwise("IMPLAUSIBLE_MW")
    return F.struct(name.alias("name"), text.alias("text"), code.alias("code"))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(c, F.lit("")), F.lit("'"))


#: What is wrong with a line by its own content, in the order of the checks: disposition and code. Codes of the same check
#: (of the hour, of a value) exclude each other. A line carries the place here, a byte, through exchanges and sorts.
FAILURES = [
    (S.QUARANTINED_SCHEMA_ERROR, "SCHEMA_DRIFT"),
    (S.QUARANTINED_PARSE_ERROR, "FIELD_COUNT_MISMATCH"),
    (S.QUARANTINED_PARSE_ERROR, T.INVALID_OPERATING_DATE),
    (S.QUARANTINED_PARSE_ERROR, T.INVALID_HOUR_ENDING),
    (S.QUARANTINED_PARSE_ERROR, T.INVALID_DST_FLAG),
    (S.QUARANTINED_PARSE_ERROR, T.NONEXISTENT_LOCAL_HOUR),
    (S.QUARANTINED_PARSE_ERROR, T.UNEXPECTED_DST_FLAG),
    (S.QUARANTINED_INVALID_VALUE, "INVALID_IN_USE_FLAG"),
    (S.QUARANTINED_INVALID_VALUE, "MISSING_MODEL"),
    (S.QUARANTINED_INVALID_VALUE, "NON_FINITE_MW"),
    (S.QUARANTINED_INVALID_VALUE, "UNPARSEABLE_MW"),
    (S.QUARANTINED_INVALID_VALUE, "IMPLAUSIBLE_MW"),
]
_CONFLICT, _REPEAT = len(FAILURES), len(FAILURES) + 1
OUTCOMES = [*FAILURES, (S.QUARANTINED_KEY_CONFLICT, "SAME_KEY_DIFFERENT_VALUES"), (S.DUPLICATE_IDENTICAL, "EXACT_REPEAT")]


def _first_of(tests: list[Column], start: int = 0) -> Column:
    """The number of the first test that holds, counted from ``start``, or null."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(k)) for k, test in enumerate(tests, start)]).cast("tinyint")


def parse(lines: DataFrame, report: Report) -> DataFrame:
    """The fields of each line, and ``check``: the number of the first check of ``FAILURES`` that it fails, or null.

    The number stands for the reason, which is put into words where it is asked for: neither texts nor the code that
    makes them are in the way of lines that pass."""

    def field(name: str) -> Column:
        return F.get("fields", F.lit(report.header.index(name)))

    rows = lines.where("row_number > 0").withColumns(
        {
            "operating_date": T.parse_operating_date(field(report.day)),
            "hour_ending": T.parse_hour_ending(field("HourEnding")),
            "dst_flag": T.parse_dst_flag(field("DSTFlag")),
            "model": F.trim(field("Model")) if report.is_forecast else F.lit(None).cast("string"),
            "_use": F.upper(F.trim(field("InUseFlag"))) if report.is_forecast else F.lit("Y"),
        }
    )
    rows = rows.withColumn("_hour", T.resolve_hour(F.col("operating_date"), F.col("hour_ending"), F.col("dst_flag")))
    tests = [
        F.trim("header") != ",".join(report.header),
        F.size("fields") != len(report.header),
        F.col("operating_date").isNull(),
        F.col("hour_ending").isNull(),
        F.col("dst_flag").isNull(),
        *[F.col("_hour.error_code") == code for code in (T.NONEXISTENT_LOCAL_HOUR, T.UNEXPECTED_DST_FLAG)],
        ~F.coalesce(F.col("_use").isin("Y", "N"), F.lit(False)),
        F.coalesce(F.col("model"), F.lit("")) == "" if report.is_forecast else F.lit(False),
    ]
    rows = rows.withColumn("_early", _first_of(tests))
    # values are read only where all before them is sound
    asked = F.col("_early").isNull()
    texts = F.array(*[field(c) for c, _ in report.zones])
    rows = rows.withColumn("_plain", asked & F.coalesce(F.array_join(texts, ",", "").rlike(f"^{_PLAIN}(,{_PLAIN}){{{len(report.zones) - 1}}}$"), F.lit(False)))
    rows = rows.withColumn("mw", F.when(F.col("_plain"), F.transform(texts, lambda t: t.cast("double"))).when(asked, F.transform(texts, _number)))
    # only lines with a value that is not plain and plausible pay for finding out which is the first, and it alone is judged
    sound = F.col("_plain") & (F.array_max("mw") <= MAX_MW)
    rows = rows.withColumn("_at", F.when(asked & ~F.coalesce(sound, F.lit(False)), F.array_position(F.transform("mw", _plausible), False).cast("int") - 1))
    at = F.col("_at")
    names = F.array(*[F.lit(c) for c, _ in report.zones])
    rows = rows.withColumn("bad", F.when(at >= 0, _checked(F.get(names, at), F.get(texts, at), F.get("mw", at))))
    values = _first_of([F.col("bad.code") == code for code in ("NON_FINITE_MW", "UNPARSEABLE_MW", "IMPLAUSIBLE_MW")], len(tests))
    rows = rows.withColumn("check", F.coalesce("_early", values))
    return rows.withColumns({"in_use": F.col("_use") == "Y", "target_ts_utc": F.col("_hour.target_ts")}).select(
        "local_path", "header", "row_number", "raw_line", "fields", "check", "bad", "operating_date", "hour_ending", "dst_flag", "target_ts_utc", "model", "in_use", "mw"
    )


def _reason(r: Column, report: Report) -> Column:
    """The reason of a line's outcome in words."""

    def told(name: str) -> Column:
        return _quoted(F.get(r["fields"], F.lit(report.header.index(name))))

    zone = F.concat(r["bad"]["name"], F.lit("="), _quoted(r["bad"]["text"]), F.when(r["bad"]["code"] == "IMPLAUSIBLE_MW", F.lit(f" lies outside {MIN_MW}..{MAX_MW}")).otherwise(F.lit("")))
    hour = F.concat_ws(" ", F.lit("local hour"), r["operating_date"].cast("string"), r["hour_ending"].cast("string"), F.lit("flag"), r["dst_flag"])
    words = [
        F.concat(F.lit(f"the header should be '{','.join(report.header)}' and is "), _quoted(F.trim(r["header"]))),
        F.concat(F.size(r["fields"]).cast("string"), F.lit(f" fields where the report has {len(report.header)}")),
        F.concat(F.lit("not a date MM/DD/YYYY: "), told(report.day)),
        F.concat(F.lit("not an hour from 1:00 to 25:00: "), told("HourEnding")),
        F.concat(F.lit("not Y or N: "), told("DSTFlag")),
        hour,
        F.concat(F.lit("not Y or N: "), told("InUseFlag")) if report.is_forecast else F.lit(""),
        F.lit("no model is named"),
        zone,
        F.concat(F.lit("lines "), r["first"].cast("string"), F.lit(" and "), r["other"].cast("string"), F.lit(" give different values for "), F.date_format(r["target_ts_utc"], "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(", model "), _quoted(r["model"])),
        F.concat(F.lit("same as line "), r["first"].cast("string")),
    ]
    # codes of one check share their words
    places = [[0], [1], [2], [3], [4], [5, 6], [7], [8], [9, 10, 11], [_CONFLICT], [_REPEAT]]
    out = F.when(r["outcome"] == 0, words[0])
    for ks, w in zip(places[1:], words[1:], strict=True):
        out = out.when(r["outcome"].isin(ks), w)
    return out


def classify(lines: DataFrame, report: Report) -> DataFrame:
    """Add ``disposition``, ``reason_code``, ``reason`` and the parsed values to the lines of one report's files.

    ``lines`` is ``sources.files.lines``; rows of number 0 (files without data) are dropped. Parsed columns:
    operating_date, hour_ending, dst_flag, target_ts_utc, model, in_use, values (map of zone to MW).

    Lines of a key are compared where one exchange brings them together, or none if the lines come dealt by
    ``local_path``. What is sorted there is a byte for all checks and, of lines that parse, the values. Reasons are put into words after it, by a lambda
    that lines without one do not enter; where nobody selects them they are not made at all.
    """
    # lines that parse, by key: equal to the first line, or in conflict with it
    good = F.col("check").isNull()
    rows = parse(lines, report).withColumns({"_good": good, "mw": F.when(good, F.col("mw"))})
    whole = Window.partitionBy("local_path", "_good", "target_ts_utc", "model")
    inside = whole.orderBy("row_number")
    rows = rows.withColumn("_first", F.first(F.struct("row_number", F.struct("mw", "in_use").alias("payload"))).over(inside))
    differs = F.col("_good") & (F.struct("mw", "in_use") != F.col("_first.payload"))
    rows = rows.withColumns({"_differs": differs, "_clash": F.max(F.when(differs, F.col("row_number"))).over(whole)})
    first = F.col("row_number") == F.col("_first.row_number")
    outcome = (
        F.when(~F.col("_good"), F.col("check"))
        .when((first & F.col("_clash").isNotNull()) | (~first & F.col("_differs")), F.lit(_CONFLICT).cast("tinyint"))
        .when(~first, F.lit(_REPEAT).cast("tinyint"))
    )
    rows = rows.withColumns({"outcome": outcome, "first": F.col("_first.row_number"), "other": F.when(first, F.col("_clash")).otherwise(F.col("row_number"))})
    asked = F.array(F.struct("header", "fields", "bad", "operating_date", "hour_ending", "dst_flag", "target_ts_utc", "model", "first", "other", "outcome"))
    return rows.select(
        "local_path", "header", "row_number", "raw_line",
        F.coalesce(F.get(F.array(*[F.lit(d) for d, _ in OUTCOMES]), F.col("outcome")), F.lit(S.ACCEPTED)).alias("disposition"),
        F.get(F.array(*[F.lit(c) for _, c in OUTCOMES]), F.col("outcome")).alias("reason_code"),
        F.when(F.col("outcome").isNotNull(), F.get(F.transform(asked, lambda r: _reason(r, report)), F.lit(0))).alias("reason"),
        "operating_date", "hour_ending", "dst_flag", "target_ts_utc", "model", "in_use",
        F.when(F.col("outcome").isNull(), F.map_from_arrays(F.array(*[F.lit(z) for _, z in report.zones]), F.col("mw"))).alias("values"),
    )


def observations(classified: DataFrame, files: DataFrame, report: Report) -> DataFrame:
    """One row for each zone of each accepted line."""
    value = "forecast_mw" if report.is_forecast else "actual_mw"
    more = ["model", F.col("in_use").alias("is_ercot_model_in_use")] if report.is_forecast else []
    named = files.select("local_path", "source_file_id", "publication_ts_utc")
    rows = classified.where(F.col("disposition") == S.ACCEPTED).join(named, "local_path")
    head = ["source_file_id", F.col("row_number").alias("source_row_number"), "publication_ts_utc", "target_ts_utc", "operating_date", "hour_ending", "dst_flag"]
    return rows.select(*head, *more, F.explode("values").alias("weather_zone", value)).select(*[c if isinstance(c, str) else "source_row_number" for c in head], "weather_zone", *(["model", "is_ercot_model_in_use"] if more else []), value)


def ledger(classified: DataFrame, files: DataFrame) -> DataFrame:
    """One row for each source line: what became of it, and why."""
    named = files.select("local_path", "source_file_id", F.col("original_filename").alias("source_filename"), "report_key")
    return classified.join(named, "local_path").select("source_file_id", "source_filename", "report_key", F.col("row_number").alias("source_row_number"), "raw_line", "disposition", "reason_code", "reason")


def file_facts(lines: DataFrame) -> DataFrame:
    """Raw rows and header fingerprint of each file."""
    return lines.groupBy("local_path").agg(F.count(F.when(F.col("row_number") > 0, 1)).alias("raw_row_count"), fingerprint(F.first("header")).alias("schema_fingerprint"), F.first("header").alias("header"))


def unaccounted(facts: DataFrame, classified: DataFrame) -> DataFrame:
    """Files whose lines and dispositions differ in number; empty if the accounting holds."""
    counted = classified.groupBy("local_path").agg(F.count(F.lit(1)).alias("dispositions"))
    return facts.join(counted, "local_path", "left").where(F.col("raw_row_count") != F.coalesce("dispositions", F.lit(0))).select("local_path", "raw_row_count", "dispositions")


def unmatched(lines: DataFrame, classified: DataFrame) -> DataFrame:
    """``(local_path, raw_row_count, dispositions)`` of files in which lines and dispositions are not one to one; empty if the
    accounting holds. A line that is lost and another that is told twice do not make up for each other."""
    which = F.sum(F.xxhash64("row_number").cast("decimal(38,0)"))
    read = lines.where("row_number > 0").groupBy("local_path").agg(F.count(F.lit(1)).alias("raw_row_count"), which.alias("_read"))
    told = classified.groupBy("local_path").agg(F.count(F.lit(1)).alias("dispositions"), which.alias("_told"))
    both = read.join(told, "local_path", "full")
    return both.where(~F.col("_read").eqNullSafe(F.col("_told"))).select("local_path", F.coalesce("raw_row_count", F.lit(0)).alias("raw_row_count"), F.coalesce("dispositions", F.lit(0)).alias("dispositions"))


def unpivot(df: DataFrame, ids: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Wide to long: one row for each of ``columns`` (source column: name in the result)."""
    renamed = df.select(*ids, *[F.col(c).alias(n) for c, n in columns.items()])
    return renamed.unpivot(ids, list(columns.values()), name, value)


def disposition_counts(ledger_rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts by disposition and the like, with the least sample line."""
    return ledger_rows.groupBy(*by).agg(*counted_with_sample("rows"))


def counted_with_sample(count: str) -> list[Column]:
    """The number of ledger rows of a group and the least sample line, for groups that are few.

    The least of texts alone makes Spark sort all rows by their group first. A collected list, here of nothing, makes it
    hold the groups in a hash table instead, which falls back to the sort if they are many."""
    none = F.size(F.collect_list(F.when(F.lit(False), F.lit(0))))
    sample = F.min(F.concat("source_filename", F.lit(" row "), F.col("source_row_number").cast("string")))
    return [(F.count(F.lit(1)) + none).alias(count), sample.alias("sample")]


