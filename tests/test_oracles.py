"""Every registered query runs; those with an oracle agree with it; plans stay joinable."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tablewright.plans.views import TABLES

from conftest import FOLDER

QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    yield con
    con.close()


def canonical(table):
    names = sorted(table.column_names)
    types = {n: str(table.schema.field(n).type).replace("large_", "") for n in names}
    rows = sorted(repr(tuple(r[n] for n in names)) for r in table.select(names).to_pylist())
    return types, rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    types, rows = canonical(df.toArrow())
    if name in ORACLES:
        expected_types, expected = canonical(duck.execute(ORACLES[name]).to_arrow_table())
        assert types == expected_types
        assert rows == expected
    else:
        assert rows


def test_entry(spark):
    assert entry(spark).count() == 200


def test_survey_ids_are_covered():
    """Every inventory id has a query; the prefixes are the ids."""
    counts = {
        "io": 14, "pr": 12, "str": 8, "dt": 7, "arr": 3, "geo": 7, "mv": 9, "pf": 11, "jn": 10, "ag": 26, "wn": 10,
        "st": 4, "sa": 5, "sp": 7, "ss": 8, "ml": 27, "ev": 18, "rc": 15, "tx": 10, "fc": 4, "bk": 1, "eq": 1, "wi": 1, "ph": 1,
    }
    have = {n.split("_")[0] for n in QUERIES}
    wanted = {f"{p}{i:02d}" for p, n in counts.items() for i in range(1, n + 1)}
    assert wanted <= have
