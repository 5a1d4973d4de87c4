import csv
import io
import os
import zipfile
from datetime import UTC, date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hindcast import schemas as S
from hindcast.operators import normalize
from hindcast.plans import coverage as cov
from hindcast.sources import archive, files, synthetic
from hindcast.streaming.intake import intake

HEADER = ",".join(S.ACTUAL_LOAD.header)


def classified(spark, lines, header=HEADER, report=S.ACTUAL_LOAD):
    rows = [("f", header, k, line, line.split(",")) for k, line in enumerate(lines, start=2)]
    return normalize.classify(spark.createDataFrame(rows, files.LINES), report).orderBy("row_number")


def line(day="09/22/2026", he="12:00", flag="N", mw="100.5", n=9):
    return ",".join([day, he, *[mw] * n, flag])


@pytest.mark.parametrize(
    ("text", "code"),
    [
        (line(), None),
        (line(n=8), "FIELD_COUNT_MISMATCH"),
        (line(day="9/22/2026"), "INVALID_OPERATING_DATE"),
        (line(day="02/30/2026", he="x"), "INVALID_OPERATING_DATE"),
        (line(he="26:00"), "INVALID_HOUR_ENDING"),
        (line(flag="?"), "INVALID_DST_FLAG"),
        (line(flag="Y"), "UNEXPECTED_DST_FLAG"),
        (line(day="03/08/2026", he="3:00"), "NONEXISTENT_LOCAL_HOUR"),
        (line(mw="abc"), "UNPARSEABLE_MW"),
        (line(mw=""), "UNPARSEABLE_MW"),
        (line(mw="1.0d"), "UNPARSEABLE_MW"),
        (line(mw="nan"), "NON_FINITE_MW"),
        (line(mw="-inf"), "NON_FINITE_MW"),
        (line(mw="200000.1"), "IMPLAUSIBLE_MW"),
        (line(mw="-1"), "IMPLAUSIBLE_MW"),
        (line(mw="1_000"), None),
        (line(mw="2e5"), None),
    ],
)
def test_first_failure_wins(spark, text, code):
    (r,) = classified(spark, [text]).collect()
    assert r["reason_code"] == code
    assert (r["disposition"] == S.ACCEPTED) == (code is None)
    if code is None:
        assert len(r["values"]) == 9


def test_duplicates_and_conflicts(spark):
    a, b, c = line(mw="1"), line(mw="2"), line(mw="3")
    rows = classified(spark, [a, a, b, a, c, line(he="13:00")]).collect()
    assert [r["disposition"].split("_")[-1] for r in rows] == ["CONFLICT", "IDENTICAL", "CONFLICT", "IDENTICAL", "CONFLICT", "ACCEPTED"]
    assert "2 and 6" in rows[0]["reason"] and rows[0]["values"] is None
    assert [r["disposition"] for r in classified(spark, [a, a]).collect()] == [S.ACCEPTED, S.DUPLICATE_IDENTICAL]


def test_a_changed_header_quarantines_the_file(spark):
    assert {r["reason_code"] for r in classified(spark, [line(), line(n=2)], HEADER.replace("WEST", "WST")).collect()} == {"SCHEMA_DRIFT"}


def test_zones_go_by_name(spark):
    cells = ["09/22/2026", "12:00", *map(str, range(1, 10)), "N"]
    (r,) = classified(spark, [",".join(cells)]).collect()
    assert (r["values"]["SOUTHERN"], r["values"]["SOUTH_CENTRAL"], r["values"]["SYSTEM_TOTAL"]) == (6.0, 7.0, 9.0)


def test_names_round_trip(spark):
    at = datetime(2026, 9, 23, 10, 30, 0, 500000)
    df = spark.createDataFrame([(at,)], "t timestamp").withColumn("name", files.file_name(S.LOAD_FORECAST, F.col("t")))
    r = df.withColumn("back", files.publication_ts(F.col("name"))).first()
    assert r["name"] == "cdr.00014837.0000000000000000.20260923.053000500.LFMODWEATHERNP3565_csv.zip" and r["back"] == at
    with pytest.raises(Exception, match="unrecognised file name"):
        spark.createDataFrame([("x.zip",)], "name string").select(files.publication_ts(F.col("name"))).collect()


def name_of(report, stamp):
    return f"cdr.{report.type_id:0>8}.{0:016d}.{stamp}.{report.marker}_csv.zip"


def test_listing(spark):
    name = name_of(S.LOAD_FORECAST, "20260923.053000000")
    later = name_of(S.LOAD_FORECAST, "20260923.063000000")
    other = name_of(S.ACTUAL_LOAD, "20260923.063000000")
    page = "".join(f"<td>{n}</td><a href='/x?doclookupId={d}'>zip</a>" for n, d in ((name, 1), (later, 2), (other, 3), (name, 4)))
    got = files.parse_listing(spark, spark.createDataFrame([(page,)], "html string"), S.LOAD_FORECAST).collect()
    assert [(r["filename"], r["doc_id"]) for r in got] == [(later, "2"), (name, "4")]


def test_scan_and_lines(spark, tmp_path):
    synthetic.build(spark, "pass", tmp_path)
    scanned = files.scan(spark, str(tmp_path), "actual_load", content=True)
    assert scanned.count() == 2 and files.scan(spark, str(tmp_path), "load_forecast").count() == 48
    rows = files.lines(scanned).collect()
    assert sorted({r["row_number"] for r in rows}) == list(range(2, 26)) and {r["header"] for r in rows} == {HEADER}
    assert files.scan(spark, str(tmp_path / "none"), "actual_load").count() == 0
    bad = tmp_path / "actual_load" / name_of(S.ACTUAL_LOAD, "20251231.180000000")
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("a.csv", "x")
        z.writestr("b.csv", "y")
    with pytest.raises(Exception, match="expected one csv member"):
        files.lines(files.scan(spark, str(tmp_path), "actual_load", content=True)).collect()


def test_stream_intake(spark, tmp_path):
    synthetic.build(spark, "pass", tmp_path / "raw")
    counts = []
    query = intake(spark, str(tmp_path / "raw"), S.ACTUAL_LOAD, lambda o, led, k: counts.append((o.count(), led.count())), str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert [sum(c) for c in zip(*counts, strict=True)] == [2 * 24 * 9, 48]


def held(spark, *instants):
    return spark.createDataFrame([("load_forecast", t) for t in instants], "report_key string, publication_ts_utc timestamp")


def test_coverage(spark):
    full = [datetime(2026, 3, 6, 6 + h, 30) for h in range(18)] + [datetime(2026, 3, 7, h, 30) for h in range(6)]
    gone = {4, 8, 10, 11, 12}
    got = cov.coverage(spark, held(spark, *[t for k, t in enumerate(full) if k not in gone], full[0]), S.LOAD_FORECAST, date(2026, 3, 6), date(2026, 3, 6))
    assert (got.held, got.expected, [h for _, h in got.missing]) == (19, 24, sorted(gone))
    assert "19/24" in got.summary()
    none = cov.coverage(spark, held(spark), S.LOAD_FORECAST, date(2026, 3, 7), date(2026, 3, 9))
    assert (none.held, none.expected, len(none.missing)) == (0, 24 + 23 + 24, 71)
    autumn = cov.coverage(spark, held(spark, *[datetime(2026, 11, 1, 5 + h, 30) for h in range(19)], *[datetime(2026, 11, 2, h, 30) for h in range(5)]), S.LOAD_FORECAST, date(2026, 11, 1), date(2026, 11, 1))
    assert (autumn.held, autumn.expected) == (24, 25)
    daily = cov.coverage(spark, spark.createDataFrame([("actual_load", datetime(2026, 3, d, 11, 50)) for d in range(1, 6)], "report_key string, publication_ts_utc timestamp"), S.ACTUAL_LOAD, date(2026, 3, 1), date(2026, 3, 5))
    assert (daily.held, daily.expected, daily.pct) == (5, 5, 100.0)
    assert "| load_forecast | 19 | 24 | 79.2 |" in cov.retrieval_report([got], [("load_forecast", date(2026, 3, 6), "never published")])


def test_files_outside_the_time_are_never_opened(spark, tmp_path):
    folder = tmp_path / "actual_load"
    folder.mkdir()
    for day in range(1, 7):
        (folder / name_of(S.ACTUAL_LOAD, f"2026010{day}.120000000")).write_bytes(zipped("h\n"))
    scanned = files.scan(spark, str(tmp_path), "actual_load", content=True, since=datetime(2026, 1, 2, tzinfo=UTC), until=datetime(2026, 1, 4, tzinfo=UTC))
    for day in (1, 4, 5, 6):  # the listing knows these files; opening one would fail
        os.remove(folder / name_of(S.ACTUAL_LOAD, f"2026010{day}.120000000"))
    assert sorted(r["original_filename"].split(".")[3] for r in scanned.collect()) == ["20260102", "20260103"]
    (folder / "odd_csv.zip").write_bytes(b"x")
    with pytest.raises(Exception, match="unrecognised file name"):
        files.scan(spark, str(tmp_path), "actual_load", until=datetime(2026, 1, 4, tzinfo=UTC)).collect()


def test_long_files_leave_python_in_parts(spark, tmp_path, monkeypatch):
    n = 2 * files.BATCH_LINES + 5
    text = "\ufeffa,b\r\n" + "".join(f"{k},x\r\n" for k in range(n)) + "last\x0bline"
    got = list(files._read([pa.RecordBatch.from_pydict({"local_path": ["p"], "content": [zipped(text)]})]))
    assert [b.num_rows for b in got] == [files.BATCH_LINES, files.BATCH_LINES, 7]
    assert [x for b in got for x in b.column("raw_line").to_pylist()][-2:] == ["last", "line"] and got[-1].column("row_number")[-1].as_py() == n + 3
    assert got[0].column("header")[0].as_py() == "a,b"


def test_fields_are_those_of_the_csv_module(spark):
    lines = ["", ",", "a,b", '"a,b",c', 'a"b,c', '"a""b",,', '"a"b,c', '"open,b', '"a""', ' "a",b', '""', '"",""', "x,,", '"a"",b"c"",d', "é,\u00a0", "1,2,3"]
    rng = __import__("random").Random(5)
    lines += ["".join(rng.choices('ab",  é', k=rng.randint(1, 12))) for _ in range(400)]
    got = {r["line"]: r["f"] for r in spark.createDataFrame([(x,) for x in lines], "line string").select("line", files.split_fields(F.col("line")).alias("f")).collect()}
    for x in lines:
        assert got[x] == next(csv.reader([x]), []), x


def zipped(text, inner="a.csv"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(inner, text)
    return out.getvalue()


def test_payloads_are_unwrapped(spark):
    one, two = zipped("a\n1\n"), zipped("a\n2\n")
    both = io.BytesIO()
    with zipfile.ZipFile(both, "w") as z:
        z.writestr("x/1.zip", one)
        z.writestr("2.ZIP", two)
        z.writestr("note.txt", "n")
    deep = zipped(both.getvalue(), "deep.zip")
    table = lambda *p: spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(p)], "id int, payload binary")
    rows = archive.unwrap(table(one, both.getvalue(), deep)).collect()
    assert sorted((r["id"], r["member"], bytes(r["content"])) for r in rows) == sorted([(0, "", one), *[(i, m, c) for i in (1, 2) for m, c in (("x/1.zip", one), ("2.ZIP", two))]])
    for bad, told in ((b"<html>", "is no zip archive"), (zipped("x", "readme.txt"), "neither a zip nor a csv"), (b"", "is no zip archive")):
        with pytest.raises(Exception, match=told):
            archive.unwrap(table(bad)).collect()


def test_archive_records(spark):
    records = [
        '{"docId": 1, "postDatetime": "2026-03-08T05:30:00", "friendlyName": "x"}',
        '{"docID": "2", "postDatetime": "2026-03-08T11:30:00Z"}',
        '{"docId": 3, "postDatetime": "", "postDatetimeUTC": "2026-03-08T01:30:00-03:00"}',
        '{"docId": 0, "postDatetime": "2026-11-01T01:30:00.250"}',
    ]
    rows = archive.archive_entries(spark.createDataFrame([(r,) for r in records], "record string")).select("doc_id", F.col("post_ts_utc").cast("string").alias("at"), "friendly_name").collect()
    assert [tuple(r) for r in rows] == [("1", "2026-03-08 10:30:00", "x"), ("2", "2026-03-08 11:30:00", ""), ("3", "2026-03-08 04:30:00", ""), ("0", "2026-11-01 06:30:00.25", "")]
    for bad in ("{}", "not json", None, '{"postDatetime": "soon"}'):
        with pytest.raises(Exception, match="no time of posting"):
            archive.archive_entries(spark.createDataFrame([(bad,)], "record string")).collect()


def test_a_name_on_several_pages_has_its_last_document(spark):
    n = name_of(S.ACTUAL_LOAD, "20260101.120000000")
    link = lambda i: f'<td>{n}</td><a href="/x?doclookupId={i}">'
    pages = spark.createDataFrame([(2, link(5)), (1, link(9) + link(7))], "page int, html string")
    assert [r["doc_id"] for r in files.parse_listing(spark, pages, S.ACTUAL_LOAD).collect()] == ["5"]
    assert [r["doc_id"] for r in files.parse_listing(spark, pages.where("page = 1"), S.ACTUAL_LOAD).collect()] == ["7"]


def test_lines_meet_behind_one_exchange(spark):
    rows = spark.createDataFrame([("f", HEADER, 2, line(), line().split(","))], files.LINES)
    told = normalize.classify(rows, S.ACTUAL_LOAD)
    assert told._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    counted = normalize.disposition_counts(told.select("disposition", F.col("local_path").alias("source_filename"), F.col("row_number").alias("source_row_number")), ["disposition"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # keys and values move, texts and reasons do not
    assert plan.count("Exchange hashpartitioning") == 2 and "give different values" not in plan and "header should be" not in plan.split("Exchange hashpartitioning(local_path")[0]


def test_lines_that_come_dealt_by_file_are_not_dealt_again(spark):
    rows = spark.createDataFrame([("f", HEADER, 2, line(), line().split(","))], files.LINES).repartition(3, "local_path")
    told = normalize.classify(rows, S.ACTUAL_LOAD).select("disposition", "reason_code", F.col("local_path").alias("source_filename"), F.col("row_number").alias("source_row_number"))
    plan = normalize.disposition_counts(told, ["disposition", "reason_code"])._jdf.queryExecution().executedPlan().toString()
    # nothing but the check's number and the values goes through the sort, and the counts need none
    sort = next(x for x in plan.splitlines() if "Sort [local_path" in x)
    assert plan.count("Exchange hashpartitioning(local_path") == 1 and "Sort [disposition" not in plan and "hour_error" not in plan and "bad" not in sort


@pytest.mark.parametrize(
    ("cells", "told"),
    [
        (["1", "1_0", "inf", "x", "-1", "2", "3", "4", "5"], ("NON_FINITE_MW", "FAR_WEST='inf'")),
        (["1", "1e999", "x", "2", "2", "2", "3", "4", "5"], ("NON_FINITE_MW", "EAST='1e999'")),
        (["1", "2", "3", "4", "5", "6", "7", "8", "2e6"], ("IMPLAUSIBLE_MW", "TOTAL='2e6' lies outside 0.0..200000.0")),
        (["", "nan", "-1", "4", "5", "6", "7", "8", "9"], ("UNPARSEABLE_MW", "COAST=''")),
        (["-0.0", "1_0", " 2 ", "4.", ".5", "6", "7", "8", "9"], (None, None)),
    ],
)
def test_the_first_bad_value_is_told(spark, cells, told):
    good, late = classified(spark, [",".join(["09/22/2026", "12:00", *cells, "N"]), ",".join(["09/22/2026", "12:00", *cells, "?"])]).collect()
    assert (good["reason_code"], good["reason"]) == told and late["reason_code"] == "INVALID_DST_FLAG"


def test_gaps_are_runs_of_due_hours(spark):
    days = spark.createDataFrame([(date(2026, 3, 7),), (date(2026, 3, 8),), (date(2026, 3, 9),)], "day date")
    due = cov.expected_publications(days, S.LOAD_FORECAST)  # on the 8th the clocks skip an hour
    held = [(d, h) for d in (7, 8, 9) for h in range(24) if not (d == 7 and h >= 22 or d == 8 and h < 4 or d == 9 and h in (5, 23))]
    counts = spark.createDataFrame([(date(2026, 3, d), h, 1) for d, h in held], "day date, hour int, n bigint")
    measured = due.join(counts, ["day", "hour"], "left").withColumn("missing", F.col("expected") - F.coalesce("n", F.lit(0)))
    rows = sorted(tuple(r) for r in cov.gap_runs(measured).collect())
    assert rows == [(date(2026, 3, 7), 22, date(2026, 3, 8), 3, 5, 5), (date(2026, 3, 9), 5, date(2026, 3, 9), 5, 1, 1), (date(2026, 3, 9), 23, date(2026, 3, 9), 23, 1, 1)]
    two = measured.withColumn("report_key", F.lit("x")).unionByName(measured.withColumn("report_key", F.lit("y")))
    assert cov.gap_runs(two, ["report_key"]).groupBy("report_key").count().orderBy("report_key").collect() == [("x", 3), ("y", 3)]


def test_statement_of_what_is_held(spark):
    daily = [("actual_load", datetime(2026, 1, d, 11, 50)) for d in (1, 2, 4)]
    hourly = [("load_forecast", datetime(2026, 1, 1, 6 + h, 30)) for h in range(18) if h not in (3, 4)] + [("load_forecast", datetime(2026, 1, 2, h, 30)) for h in range(6)]
    scanned = spark.createDataFrame([*daily, *hourly], "report_key string, publication_ts_utc timestamp")
    listed = spark.createDataFrame([("actual_load", date(2026, 1, 3), 1), ("load_forecast", date(2026, 1, 1), 22)], "report_key string, day date, listed bigint")
    one, four = date(2026, 1, 1), date(2026, 1, 4)
    text = cov.statement(spark, scanned, {S.LOAD_FORECAST: (one, one), S.ACTUAL_LOAD: (one, four)}, listed)
    assert "22 of 24 publications are held (91.7 %)" in text and "| 2026-01-01 | 24 | 22 | 22 | never published |" in text
    assert "* 2026-01-01 03:00 to 2026-01-01 04:59, 2 publications" in text and "1 runs of hours" in text
    assert "3 of 4 publications" in text and "| 2026-01-03 | 1 | 0 | 1 | not retrieved |" in text
    alone = cov.statement(spark, scanned, {S.ACTUAL_LOAD: (one, date(2026, 1, 2))})
    assert "Nothing is missing." in alone
    assert "| unknown |" in cov.statement(spark, scanned.where("false"), {S.ACTUAL_LOAD: (one, one)})
