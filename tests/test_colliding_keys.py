"""Queries against their SQL where parts have keys of seven digits, of which several are given one identifier."""

import os

import duckdb
import pytest

from grantlens import plans
from grantlens.plans.views import TABLES

from test_oracle import SF, plain

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
SHIFTS = (0, 100_000, *range(1_000_000, 1_002_000, 200))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("colliding")
    c = duckdb.connect()
    keys = {"part": ("p_partkey",), "supplier": ("s_suppkey",), "customer": ("c_custkey",), "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey", "l_partkey", "l_suppkey")}
    shift = lambda k: f"{k} + {list(SHIFTS)}[i + 1]" if k.endswith("partkey") else f"{k} + i * 100000"
    size = lambda t: ", CASE WHEN i % 3 <> 2 THEN 5 ELSE p_size END AS p_size" if t == "part" else ""
    for t in TABLES:
        rows = f"'{SF}/{t}.parquet'"
        if t in keys:
            rows = f"(SELECT * EXCLUDE (i) REPLACE ({', '.join(f'{shift(k)} AS {k}' for k in keys[t])}{size(t)}) FROM range({len(SHIFTS)}) r(i), {rows} ORDER BY i, {', '.join(keys[t])})"
        c.execute(f"COPY (SELECT * FROM {rows}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return str(out)


def in_order(name, cell):
    """A list's items by themselves: this query's SQL leaves open how several statuses of one identifier follow one another."""
    return sorted(cell.split("; ")) if name == "prj_id_strings" else cell


@pytest.mark.parametrize("name", [
    "cls_triage", "join_records", "rec_check", "xck_apply", "src_catalog", "snk_added", "prj_id_strings",
])
def test_query_equals_sql_on_shared_identifiers(spark, folder, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert duck.execute(plans.base.with_views("SELECT COUNT(*) > COUNT(DISTINCT (repo, id)) FROM {status}")).fetchone()[0]
    df = plans.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted(repr([in_order(name, plain(r[c])) for c in columns]) for r in df.collect())
    result = duck.execute(plans.ORACLE_SQL[name])
    names = [x[0] for x in result.description]
    want = sorted(repr([in_order(name, plain(r[names.index(c)])) for c in columns]) for r in result.fetchall())
    assert got == want
