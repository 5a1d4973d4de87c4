import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hindcast import schemas as S
from hindcast.operators import gates, normalize
from hindcast.plans import run as runs
from hindcast.plans.warehouse import Conflict, Warehouse, table_digest
from hindcast.sources import files, synthetic

EXPECTED = {
    "pass": (runs.OK, {}),
    "dst_spring_forward": (runs.OK, {}),
    "missing_forecast": (runs.NOT_READY, {"MISSING_ASOF_FORECAST": 8}),
    # of the key in conflict only the model that is not in use is left, in nine zones
    "conflicting_duplicate": (runs.NOT_READY, {"QUARANTINED_SAME_KEY_DIFFERENT_VALUES": 2, "AMBIGUOUS_MODEL_IN_USE": 9}),
    "schema_drift": (runs.NOT_READY, {"SCHEMA_DRIFT": 1, "QUARANTINED_SCHEMA_DRIFT": 48}),
}


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    done = {}

    def go(scenario):
        if scenario not in done:
            raw, house = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("house"))
            day = synthetic.build(spark, scenario, raw)
            done[scenario] = (raw, house, day, runs.run(spark, str(raw), house, day, reports=f"{house}-reports", window_days=1))
        return done[scenario]

    return go


@pytest.mark.parametrize("scenario", synthetic.SCENARIOS)
def test_verdicts(ran, scenario):
    code, results = ran(scenario)[3]
    found = {r.code: r.count for r in results[0].reasons}
    expected_code, expected = EXPECTED[scenario]
    assert code == expected_code, found
    assert {k: found.get(k) for k in expected} == expected
    assert set(found) <= set(expected) | {"STALE_FORECAST_VINTAGE"}
    if code == runs.OK:
        assert results[0].metrics["evaluation_rows"] == (184 if "dst" in scenario else 192)
        assert [r.status for r in results] == ["PASS", "PASS"]


def test_ledger_has_one_disposition_a_line(spark, ran):
    raw, house, day, _ = ran("conflicting_duplicate")
    store = Warehouse(spark, house)
    ledger = store.read("source_row", day)
    assert ledger.count() == store.read("source_file", day).agg(F.sum("raw_row_count")).first()[0]
    assert ledger.groupBy("source_file_id", "source_filename", "source_row_number").count().where("count > 1").isEmpty()
    accepted = ledger.where("disposition = 'ACCEPTED' and report_key = 'load_forecast'").count()
    assert store.read("forecast_vintage", day).count() == 9 * accepted
    both = ledger.where("reason_code = 'SAME_KEY_DIFFERENT_VALUES'").collect()
    assert len(both) == 2 and both[0]["reason"] == both[1]["reason"]


def test_a_rerun_replaces_and_is_the_same(spark, ran):
    raw, house, day, _ = ran("pass")
    store = Warehouse(spark, house)
    before = {n: table_digest(store.read(n, day)).first() for n in S.TABLES}
    runs.run(spark, str(raw), house, day, window_days=1)
    assert {n: table_digest(store.read(n, day)).first() for n in S.TABLES} == before
    assert len(json.loads((__import__("pathlib").Path(f"{house}-reports") / f"{day}_data_readiness.json").read_text())) == 6


def test_run_id_follows_contents_and_visibility(spark, ran):
    raw, _, day, _ = ran("pass")
    scanned = files.scan_all(spark, str(raw))
    one = runs.run_id(runs.visible(scanned, day), day)
    assert one == runs.run_id(runs.visible(scanned, day), day) and len(one) == 32
    assert one != runs.run_id(runs.visible(scanned, day - timedelta(days=2)), day)
    changed = scanned.withColumn("content_sha256", F.when(F.col("report_key") == "actual_load", "x").otherwise(F.col("content_sha256")))
    assert one != runs.run_id(runs.visible(changed, day), day)


def test_tampering_is_caught(spark, ran):
    _, house, day, (_, results) = ran("pass")
    (eval_id,) = (p.name for p in __import__("pathlib").Path(house, "evaluation_dataset").iterdir())
    rows = Warehouse(spark, house).evaluation(eval_id)
    late = rows.withColumn("ercot_publication_ts_utc", F.when(F.col("hour_ending") == 5, F.col("cutoff_ts_utc") + F.expr("interval 1 hour")).otherwise(F.col("ercot_publication_ts_utc")))
    assert gates.check_counts(late).first()["CUTOFF_VIOLATION"] == 8
    strict = gates.model_gate(rows, "r", day, gates.Thresholds(max_wape_pct=0.0, max_fold_wape_pct=0.0, max_peak_hour_ape_pct=0.0))
    assert {r.code for r in strict.reasons} >= {"WAPE_ABOVE_THRESHOLD", "FOLD_WAPE_ABOVE_THRESHOLD", "PEAK_HOUR_ERROR_ABOVE_THRESHOLD"}
    peak = rows.withColumn("naive_error_mw", F.when(F.col("actual_mw") == rows.where("weather_zone = 'COAST'").agg(F.max("actual_mw")).first()[0], 5000.0).otherwise(F.col("naive_error_mw")))
    assert [r.code for r in gates.model_gate(peak, "r", day).reasons][-1] == "PEAK_HOUR_ERROR_ABOVE_THRESHOLD"


def test_windows():
    assert runs.window(date(2026, 3, 24)) == (date(2026, 2, 22), date(2026, 3, 23))
    assert runs.window(date(2026, 3, 24), start=date(2026, 3, 8), end=date(2026, 3, 9)) == (date(2026, 3, 8), date(2026, 3, 9))
    assert runs.local_midnight(date(2026, 3, 9)).replace(tzinfo=None) == datetime(2026, 3, 9, 5)
    assert (runs.local_midnight(date(2026, 3, 10)) - runs.local_midnight(date(2026, 3, 8))).total_seconds() == 47 * 3600
    with pytest.raises(ValueError, match="after it ends"):
        runs.window(date(2026, 3, 24), start=date(2026, 3, 10), end=date(2026, 3, 9))
    with pytest.raises(ValueError, match="processing date"):
        runs.window(date(2026, 3, 24), end=date(2026, 3, 24))


def test_nothing_to_run_is_refused(spark, tmp_path):
    assert runs.run(spark, str(tmp_path), str(tmp_path / "w"), date(2026, 9, 23)) == (runs.NOT_READY, [])


def test_staged_tables_are_gone_and_each_file_is_read_once(spark, ran):
    _, house, day, _ = ran("pass")
    assert not [p for p in __import__("pathlib").Path(house).iterdir() if p.name.startswith("_staging")]


def test_rows_are_amended_together_and_tables_stand_before_the_first_commit(spark, ran, tmp_path):
    raw, house, day, _ = ran("missing_forecast")
    store = Warehouse(spark, house)
    before = {n: table_digest(store.read(n, day)).first() for n in S.TABLES}
    least = store.read("actual_vintage", day).agg(F.min("actual_mw")).first()[0]
    n = store.read("actual_vintage", day).where(F.col("actual_mw") == least).count()
    store.amend("actual_vintage", day, F.col("actual_mw") == least, {"actual_mw": F.lit(-5.0)})
    assert store.read("actual_vintage", day).where("actual_mw = -5").count() == n
    after = {n: table_digest(store.read(n, day)).first() for n in S.TABLES}
    assert {n for n in S.TABLES if before[n] != after[n]} == {"actual_vintage"}
    assert after["actual_vintage"]["rows"] == before["actual_vintage"]["rows"]
    Warehouse(spark, str(tmp_path / "new")).create_views()
    assert [spark.table(n).count() for n in S.TABLES] == [0, 0, 0, 0]
    store.create_views()
    assert spark.sql("SELECT count(*) AS n FROM source_row").first()["n"] == before["source_row"]["rows"]


def test_the_model_gate_needs_evidence(spark):
    columns = "weather_zone string, operating_date date, target_ts_utc timestamp, actual_mw double, naive_forecast_mw double, naive_error_mw double"
    judge = lambda rows: [r.code for r in gates.model_gate(spark.createDataFrame(rows, columns), "r", date(2026, 1, 1)).reasons]
    assert judge([]) == ["NOTHING_SCORED"]
    at = datetime(2026, 1, 1)
    assert judge([("COAST", date(2026, 1, 1), at, None, 1.0, None)]) == ["INCOMPLETE_SCORING", "NOTHING_SCORED"]
    assert judge([("COAST", date(2026, 1, 1), at, 0.0, 1.0, 1.0)]) == ["WAPE_UNDEFINED", "FOLD_WAPE_ABOVE_THRESHOLD"]
    assert judge([("COAST", date(2026, 1, 1), at, 100.0, 101.0, 1.0)]) == []


def test_of_two_commits_one_is_told(spark, tmp_path, monkeypatch):
    day = date(2026, 1, 2)
    store, other = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    tables = {n: store.read(n) for n in S.TABLES}
    assert store.version(day) == -1 and store.commit(tables, day, "one", expected=-1) == 0
    seen = store.version(day)
    assert other.commit(tables, day, "two") == 1
    with pytest.raises(Conflict, match="commit 1 was made since 0"):
        store.commit(tables, day, "three", expected=seen)
    assert store.runs()[str(day)].startswith("two-")
    # both read version 1, and the other claims 2 first but has not put its manifest in place
    (tmp_path / "_manifest" / f"_claim-{day}.2").touch()
    with pytest.raises(Conflict, match="has claimed commit 2"):
        store.commit(tables, day, "four", expected=1)
    assert store.commit(tables, day, "five") == 3 and other.runs()[str(day)].startswith("five-")
    row = (1, "x")
    first = spark.createDataFrame([row], "a int, b string")
    store.publish_evaluation(first, "e")
    held = store.evaluation("e")
    store.publish_evaluation(spark.createDataFrame([(2, "y")], "a int, b string"), "e")
    assert held.collect() == [row] and store.evaluation("e").collect() == [(2, "y")]  # readers keep what they have begun with
    assert store.vacuum(older_than_hours=1) == []
    gone = store.vacuum(older_than_hours=-1)
    assert len([g for g in gone if g.startswith("evaluation_dataset/e/")]) == 1 and len([g for g in gone if "run_id=one-" in g]) == len(S.TABLES) and not [g for g in gone if "run_id=five-" in g]
    assert store.evaluation("e").collect() == [(2, "y")] and store.read("source_row", day).collect() == []


def test_a_load_that_loses_lines_is_not_committed(spark, ran, tmp_path, monkeypatch):
    raw, _, day, _ = ran("pass")
    classify = normalize.classify

    def faulty(lines, report):
        """One file loses a line and another tells one twice: their numbers cancel."""
        out = classify(lines, report)
        paths = sorted(r[0] for r in lines.select("local_path").distinct().collect())
        if len(paths) < 2:
            return out
        lost = out.where(~((F.col("local_path") == paths[0]) & (F.col("row_number") == 3)))
        return lost.unionByName(out.where((F.col("local_path") == paths[1]) & (F.col("row_number") == 3)))

    monkeypatch.setattr(runs.normalize, "classify", faulty)
    with pytest.raises(runs.Unaccounted) as told:
        runs.run(spark, str(raw), str(tmp_path / "house"), day, window_days=1)
    assert len(told.value.files) == 2
    assert Warehouse(spark, str(tmp_path / "house")).runs() == {}
