from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hindcast.functions import time as T


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def resolved(spark, day, he, flag):
    r = one(spark, T.resolve_hour(F.lit(day), F.lit(he), F.lit(flag)).alias("r"))["r"]
    return r["target_ts"] and r["target_ts"].strftime("%m-%d %H:%M"), r["is_repeated"], r["error_code"]


@pytest.mark.parametrize(
    ("day", "he", "flag", "expected"),
    [
        (date(2026, 9, 22), 1, "N", ("09-22 05:00", False, None)),
        (date(2026, 11, 1), 2, "Y", ("11-01 06:00", True, None)),
        (date(2026, 11, 1), 2, "N", ("11-01 07:00", True, None)),
        (date(2026, 3, 8), 3, "N", (None, False, T.NONEXISTENT_LOCAL_HOUR)),
        (date(2026, 3, 8), 3, "Y", (None, False, T.NONEXISTENT_LOCAL_HOUR)),
        (date(2026, 9, 22), 5, "Y", (None, False, T.UNEXPECTED_DST_FLAG)),
        (date(2026, 9, 22), 25, "N", ("09-23 05:00", False, None)),
    ],
)
def test_resolve_hour(spark, day, he, flag, expected):
    assert resolved(spark, day, he, flag) == expected


def test_days_have_23_to_25_hours(spark):
    days = spark.createDataFrame([(date(2026, 3, 8),), (date(2026, 9, 22),), (date(2026, 11, 1),)], "day date")
    rows = T.expected_hours(days).collect()
    assert sorted((str(d), sum(r["day"] == d for r in rows)) for d in {r["day"] for r in rows}) == [("2026-03-08", 23), ("2026-09-22", 24), ("2026-11-01", 25)]
    assert [(r["hour_ending"], r["dst_flag"]) for r in sorted(rows, key=lambda r: r["start_utc"]) if r["day"] == date(2026, 11, 1)][:4] == [(1, "N"), (2, "Y"), (2, "N"), (3, "N")]
    assert [r[0] for r in days.select(T.hours_in_day(F.col("day"))).collect()] == [23, 24, 25]


def test_parsing(spark):
    r = one(spark, *[T.parse_operating_date(F.lit(t)) for t in ("09/22/2026", " 09/22/2026 ", "9/22/2026", "02/30/2026", "")], *[T.parse_hour_ending(F.lit(t)) for t in ("1:00", "01:00", "25:00", "26:00", "0:00", "1:30", "x")], *[T.parse_dst_flag(F.lit(t)) for t in (" y", "N", "X")])
    assert list(r) == [date(2026, 9, 22)] * 2 + [None] * 3 + [1, 1, 25, None, None, None, None, "Y", "N", None]


def test_minutes_count_boundaries_and_leads_round_to_even(spark):
    t = lambda s: F.lit(datetime.fromisoformat(s))
    r = one(spark, T.minute_boundaries(t("2026-01-01T05:30:00.500"), t("2026-01-01T06:00:00")), T.lead_hours(t("2026-01-01T00:30:00"), t("2026-01-02T00:00:00")), T.lead_hours(t("2026-01-01T00:30:00"), t("2026-01-02T01:00:00")))
    assert list(r) == [30.0, 24, 24]
