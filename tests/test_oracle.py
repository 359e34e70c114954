"""Every query of the reference operators against its SQL, on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from grantlens import plans
from grantlens.plans.views import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    result = duck.execute(plans.ORACLE_SQL[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    want = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in result.fetchall())
    assert got == want


def test_series_of_all_repositories_are_kept_but_derived_ones(spark):
    from grantlens.operators.catalog import without_derived

    rows = [(r.repo, r.acc) for r in plans.base.Data(spark, SF).catalog.collect()]
    got = sorted(r.acc for r in plans.QUERIES["flt_derived_series"](spark, SF).collect())
    assert len({repo for repo, _ in rows}) > 2
    assert got == sorted(acc for _, acc in rows if not (acc.startswith("gse") and acc[-1] in "37"))
    some = spark.createDataFrame([("gse1",), ("gds9",), ("GDS8",), ("phs000001",)], "acc string")
    assert sorted(r.acc for r in without_derived(some).collect()) == ["gse1", "phs000001"]


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE_SQL)


@pytest.mark.parametrize("text, want", [
    ("password: hunter2x", "password: [removed]"), ("Token for reviewers (abcd)", "Token for reviewers ([removed])"), ("passcode 12ab", "passcode [removed]"),
    ("passcode ab12c3 here", "passcode [removed] here"), ("token abcdef here", "token abcdef here"), ("token=abc", "token=abc"), ("tokens abc1", "tokens abc1"), (None, ""),
])
def test_redaction(spark, text, want):
    from pyspark.sql import functions as F

    from grantlens.functions.columns import redact

    assert spark.range(1).select(redact(F.lit(text).cast("string")).alias("x")).first().x == want


def test_nothing_outside_imports_the_training_data_package():
    from pathlib import Path

    root = Path(plans.__file__).resolve().parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "llm" not in f.read_text(), f
