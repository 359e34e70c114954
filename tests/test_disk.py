"""What is read several times is written once, and nested documents are written packed."""

import os

import pytest
from pyspark.sql import functions as F

from grantlens import plans
from grantlens.operators import records as R
from grantlens.plans.base import Data
from grantlens.sources import sinks

from test_oracle import SF

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_read_identifiers_that_are_made_once(spark):
    assert "concat(cue" in plan(Data(spark, SF).ident)
    assert "concat(cue" not in plan(plans.QUERIES["agg_candidates"](spark, SF))
    d = Data(spark, SF)
    landed = d.land("ident")
    assert "concat(cue" not in plan(landed.ident)
    assert landed.ident.columns == d.ident.columns and landed.ident.exceptAll(d.ident).isEmpty() and d.ident.exceptAll(landed.ident).isEmpty()


def test_study_groups_deal_papers_out_once(spark):
    rows = [("2", "SRA/BioProject", "SRR1"), ("2", "SRA/BioProject", "PRJ1"), ("2", "SRA/BioProject", "SRR1"), ("10", "SRA/BioProject", "SRR1"), ("10", "SRA/BioProject", "PRJ2"), (None, "EGA", "EGAD1")]
    ids = spark.createDataFrame(rows, "pmid string, repo string, id string")
    series = spark.createDataFrame([], "id string, superseries string")
    found = R.study_groups(ids, series)
    assert sorted(map(tuple, found.collect())) == [("SRA/BioProject", "PRJ1", "SRA/BioProject:PRJ1"), ("SRA/BioProject", "PRJ2", "SRA/BioProject:PRJ2"), ("SRA/BioProject", "SRR1", "SRA/BioProject:PRJ1")]
    assert plan(found).count("Join") == 1


def test_nested_documents_are_packed(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, '{"k":"a"}', 0), ("a", 1, '{"n":1}', 1), ("a", 1, '{"n":2}', 2), ("b", 0, '{"k":"b"}', 0)], "k string, depth int, body string, o int")
    path = str(tmp_path / "nested")
    sinks.write_nested(rows, path, ["k"], ["depth", "o"], ["items"])
    files = [f for f in os.listdir(path) if f.startswith("part")]
    assert files and all(f.endswith(".gz") for f in files)
    back = sinks.read_nested(spark, path, "k string, items array<struct<n:int>>").where("k is not null")
    assert sorted((r.k, [x.n for x in r["items"]]) for r in back.collect()) == [("a", [1, 2]), ("b", [])]


def test_receipts_files_are_packed_and_read_again(spark):
    df = plans.QUERIES["snk_receipts_json"](spark, SF)
    assert df.where(F.col("listed") > 0).count() and all(f.endswith(".gz") for f in df.inputFiles())
