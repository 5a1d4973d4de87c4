"""Local operating hours as Column expressions: no Python per row, no time-zone tables of our own.

Target hours are keyed by the UTC instant at which their local interval begins; hour ending 1 is [00:00, 01:00).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "America/Chicago"
#: Reason codes (fixed values).
INVALID_OPERATING_DATE = "INVALID_OPERATING_DATE"
INVALID_HOUR_ENDING = "INVALID_HOUR_ENDING"
INVALID_DST_FLAG = "INVALID_DST_FLAG"
NONEXISTENT_LOCAL_HOUR = "NONEXISTENT_LOCAL_HOUR"
UNEXPECTED_DST_FLAG = "UNEXPECTED_DST_FLAG"


def hours(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def parse_operating_date(text: Column) -> Column:
    """A real date written MM/DD/YYYY with two, two and four digits, or null."""
    t = F.trim(text)
    return F.when(t.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(t, "MM/dd/yyyy"))


def parse_hour_ending(text: Column) -> Column:
    """``H:00`` or ``HH:00`` from 1 to 25, or null. (25 is the 00:00 after the day, whatever the day's length.)"""
    h = F.regexp_extract(F.trim(text), r"^([0-9]{1,2}):00$", 1)
    n = F.when(h != "", h.cast("int"))
    return F.when(n.between(1, 25), n)


def parse_dst_flag(text: Column) -> Column:
    """``Y`` or ``N`` in any case and with any space around it, or null."""
    t = F.upper(F.trim(text))
    return F.when(t.isin("Y", "N"), t)


def _wall(day: Column, hour_ending: Column) -> Column:
    return day.cast("timestamp_ntz") + hours(hour_ending - 1)


def _to_utc(wall: Column, zone: str) -> Column:
    return F.to_utc_timestamp(wall.cast("timestamp"), zone)


def resolve_hour(day: Column, hour_ending: Column, dst_flag: Column, zone: str = ZONE) -> Column:
    """The instant of a local hour: struct(target_ts, is_repeated, error_code).

    In the repeated hour of autumn, ``Y`` is the first occurrence and ``N`` the second. An hour that the clocks skip is
    an error, and so is ``Y`` where nothing repeats; the first is tested first. The session time zone must be UTC.

    In a day of 24 hours that the clocks run through, hours are counted from its midnight; a lambda, which such days do
    not enter, looks up those of the others one by one.
    """
    start, end = midnight(day, zone), midnight(F.date_add(day, 1), zone)
    noon = F.to_utc_timestamp(day.cast("timestamp") + hours(12), zone)
    plain = (noon - start == hours(12)) & (end - noon == hours(12)) & (hour_ending <= 24)
    error = F.when(dst_flag == "Y", UNEXPECTED_DST_FLAG)
    counted = F.struct(F.when(error.isNull(), start + hours(hour_ending - 1)).alias("target_ts"), F.lit(False).alias("is_repeated"), error.alias("error_code"))
    asked = F.array(F.struct(day.alias("d"), hour_ending.alias("h"), dst_flag.alias("f")))
    return F.when(plain, counted).otherwise(F.get(F.transform(asked, lambda r: _looked_up(r["d"], r["h"], r["f"], zone)), F.lit(0)))


def _looked_up(day: Column, hour_ending: Column, dst_flag: Column, zone: str) -> Column:
    wall = _wall(day, hour_ending).cast("timestamp")
    early = F.to_utc_timestamp(wall, zone)
    missing = F.from_utc_timestamp(early, zone) != wall
    # early is one of the two instants of a repeated hour; the other lies an hour beside it
    after, before = F.from_utc_timestamp(early + hours(1), zone) == wall, F.from_utc_timestamp(early - hours(1), zone) == wall
    repeated = after | before
    first, second = F.when(before, early - hours(1)).otherwise(early), F.when(after, early + hours(1)).otherwise(early)
    error = F.when(missing, NONEXISTENT_LOCAL_HOUR).when((dst_flag == "Y") & ~repeated, UNEXPECTED_DST_FLAG)
    target = F.when(error.isNotNull(), F.lit(None).cast("timestamp")).when(dst_flag == "Y", first).otherwise(second)
    return F.struct(target.alias("target_ts"), F.coalesce(repeated & error.isNull(), F.lit(False)).alias("is_repeated"), error.alias("error_code"))


def midnight(day: Column, zone: str = ZONE) -> Column:
    """The instant at which a local day begins."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def processing_cutoff(day: Column, zone: str = ZONE) -> Column:
    """The local midnight that ends a processing date: a file is visible if published before it."""
    return midnight(F.date_add(day, 1), zone)


def expected_hours(days: DataFrame, day: str = "day", zone: str = ZONE) -> DataFrame:
    """The 23, 24 or 25 hours of each local day: (day, hour_ending, dst_flag, start_utc)."""
    start, stop = midnight(F.col(day), zone), midnight(F.date_add(day, 1), zone) - hours(1)
    rows = days.select(day, F.explode(F.sequence(start, stop, hours(1))).alias("start_utc"))
    local = F.from_utc_timestamp("start_utc", zone)
    again = F.from_utc_timestamp(F.col("start_utc") + hours(1), zone) == local
    return rows.select(day, (F.hour(local) + 1).alias("hour_ending"), F.when(again, "Y").otherwise("N").alias("dst_flag"), "start_utc")


def hours_in_day(day: Column, zone: str = ZONE) -> Column:
    return ((F.unix_micros(midnight(F.date_add(day, 1), zone)) - F.unix_micros(midnight(day, zone))) / 3_600_000_000).cast("int")


def minute_boundaries(a: Column, b: Column) -> Column:
    """How many minute boundaries lie from a to b (not whole minutes elapsed), as a double."""

    def minute(t: Column) -> Column:
        return F.unix_micros(F.date_trunc("minute", t.cast("timestamp"))) / F.lit(60_000_000.0)

    return minute(b) - minute(a)


def lead_hours(publication: Column, target: Column) -> Column:
    """Whole lead hours: minutes over 60, halves rounded to even."""
    return F.bround(minute_boundaries(publication, target) / 60.0).cast("int")


def iso_minute(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm'Z'")
