"""Each core query against its SQL in DuckDB, over whole tables."""

import math
import os

import duckdb
import pytest

from hindcast import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def text(v):
    return "null" if v is None or isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)


def result(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    con = duck.execute(queries.SQL[name])
    kinds = {c[0]: str(c[1]) for c in con.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert result(df.columns, df.collect()) == result([c[0] for c in con.description], con.fetchall())


def test_entry_stands_without_the_optional_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "hindcast", tmp_path / "hindcast", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_scans_read_only_what_a_query_uses(spark):
    plan = queries.wape_overall(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_suppkey" not in plan


def test_parts_of_lines_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(queries, "PART_LINES", 100)
    n = queries.table(spark, FOLDER, "lineitem").count()
    assert queries._placed(spark, FOLDER).rdd.getNumPartitions() == -(-n // 100)


@pytest.mark.parametrize(("name", "scans"), [("ledger_reasons", 1), ("observations_of_accepted_lines", 2), ("observations_of_forecast_lines", 2), ("ledger_by_report", 4)])
def test_lines_are_dealt_once(spark, name, scans):
    """By the file's name, as narrow rows: what is parsed does not move again."""
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(local_path") == scans and "Exchange hashpartitioning(l_orderkey" not in plan and "_good" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_the_gate_gets_its_lines_and_evaluation_from_what_is_kept(spark, monkeypatch):
    seen = {}
    whole = queries.gates.readiness

    def gate(tables, evaluation, *more):
        seen.update({"ledger": tables["source_row"], "evaluation": evaluation})
        seen["plans"] = [df._jdf.queryExecution().executedPlan().toString() for df in (tables["source_row"], evaluation)]
        return whole(tables, evaluation, *more)

    monkeypatch.setattr(queries.gates, "readiness", gate)
    queries.readiness_reasons(spark, FOLDER)
    assert all("InMemoryTableScan" in plan for plan in seen["plans"])
    # nothing stays behind
    assert all("InMemoryTableScan" not in df.select("*")._jdf.queryExecution().executedPlan().toString() for df in (seen["ledger"], seen["evaluation"]))
