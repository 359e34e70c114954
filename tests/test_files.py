"""Files in and out: nested documents, catalogs of several headers, review labels, full texts; nearest spans by brute force."""

import json
import random

from pyspark.sql import functions as F

from grantlens.operators import catalog as K
from grantlens.operators import links as L
from grantlens.operators import mentions as M
from grantlens.sources import landed, sinks


def test_nested_documents(spark, tmp_path):
    rows = [("a", 0, '{"k":"a"}', None, None), ("a", 1, '{"p":"1"}', 1, None), ("a", 2, '{"s":"x \\"y\\""}', 1, "x"), ("a", 2, '{"s":"z"}', 1, "z"), ("a", 1, '{"p":"2"}', 2, None), ("b", 0, "{}", None, None), ("c", 0, '{"k":"c"}', None, None), ("c", 1, '{"p":"é, ]}"}', 1, None)]
    df = spark.createDataFrame(rows, "k string, depth int, body string, o int, s string").repartition(3)
    sinks.write_nested(df, str(tmp_path / "out"), ["k"], ["o", "s"], ["papers", "shared"])
    found = [x for f in (tmp_path / "out").glob("part-*") for x in json.loads(f.read_text())]
    by = {x.get("k", "b"): x for x in found}
    assert by["a"] == {"k": "a", "papers": [{"p": "1", "shared": [{"s": 'x "y"'}, {"s": "z"}]}, {"p": "2", "shared": []}]}
    assert by["b"] == {"papers": []} and by["c"] == {"k": "c", "papers": [{"p": "é, ]}", "shared": []}]} and len(found) == 3
    back = sinks.read_nested(spark, str(tmp_path / "out"), "k string, papers array<struct<p:string,shared:array<struct<s:string>>>>")
    assert back.count() == 3 and back.where("k = 'a'").select(F.size("papers")).first()[0] == 2
    sinks.write_nested(df.limit(0), str(tmp_path / "none"), ["k"], ["o", "s"], ["papers", "shared"])
    assert sinks.read_nested(spark, str(tmp_path / "none"), "k string").count() == 0


def test_catalog_files_of_several_headers(spark, tmp_path):
    (tmp_path / "geo_datasets.tsv").write_text("dataset_source_id\tdataset_source_repo\tdataset_pmid\tstudy_links\nGSE1\tGEO\t1; 2,3 \tsee PRJNA77 and SRP000123\nGSE2 \tGEO\t\t\n")
    (tmp_path / "sra_datasets.tsv").write_text("extra\tdataset_source_repo\tdataset_source_id\tdataset_source_url\nx\tSRA\tPRJNA5\thttp://y/phs000001\n")
    (tmp_path / "resources_a_processed.tsv").write_text("resource_source_url\nhttp://a\n")
    (tmp_path / "resources_b_processed.tsv").write_text("n\tresource_source_url\n1\thttp://b\n2\thttp://c\n")
    found, resources = landed.catalog(spark, [f"{tmp_path}/*_datasets.tsv"], [f"{tmp_path}/resources_*_processed.tsv"])
    got = {r.acc: (r.repo, r.pmids) for r in found.collect()}
    assert got == {"gse1": ("GEO", ["1", "2", "3"]), "gse2": ("GEO", []), "prjna5": ("SRA", [])}
    assert {r.url for r in resources.collect()} == {"http://a", "http://b", "http://c"}
    named = {(r.acc, r.alias) for r in K.aliases(found).collect()}
    assert named == {("gse1", "gse1"), ("gse1", "prjna77"), ("gse1", "srp000123"), ("gse2", "gse2"), ("prjna5", "prjna5"), ("prjna5", "phs000001")}
    pairs = spark.createDataFrame([("gse1", "9"), ("prjna5", "8")], "acc string, pmid string")
    ids = spark.createDataFrame([("9", "PRJNA77", "generated"), ("8", "GSE9", "reused")], "pmid string, id string, role string")
    assert {(r.pmid, r.found, r.own) for r in K.benchmark(found, pairs, ids).collect()} == {("9", True, True), ("8", False, False)}


def test_the_last_line_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text('pmid,label,reason\n1,ON_REQUEST,first\n2,IN_ARTICLE,"two\nlines"\n\n,ON_REQUEST,no paper\n3,unknown,x\n')
    (tmp_path / "b.csv").write_text("pmid,label,reason\n 1 ,IN_ARTICLE,last,and,more\n4,ON_REQUEST\n1,no such label,x\n")
    got = {r.pmid: (r.label, r.reason) for r in landed.overrides(spark, str(tmp_path)).collect()}
    assert got == {"1": ("IN_ARTICLE", "last"), "2": ("IN_ARTICLE", "two\nlines"), "4": ("ON_REQUEST", None)}


def test_full_texts_of_two_feeds(spark, tmp_path):
    for feed, files in {"a": {"PMC1": "<article>a1", "PMC2": "<html>", "PMC3": "<article>a3"}, "b": {"PMC1": "<article>b1", "PMC2": "é" * 4900 + "<article>b2", "PMC3": "é" * 5000 + "<article>"}}.items():
        (tmp_path / feed).mkdir()
        for name, text in files.items():
            (tmp_path / feed / f"{name}.xml").write_text(text)
    feeds = {x: landed.fulltext_files(spark, str(tmp_path / x)) for x in ("a", "b")}
    is_open = spark.createDataFrame([("PMC1", True), ("PMC2", True), ("PMC3", False), ("PMC4", True)], "pmcid string, is_open boolean")
    df = landed.fulltext(feeds, is_open)
    assert {(r.pmcid, r.source, r.xml[-2:]) for r in df.collect()} == {("PMC1", "a", "a1"), ("PMC2", "b", "b2")}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan


def test_nearest_spans(spark):
    r = random.Random(4)
    points = [(k, r.randint(0, 60)) for k in range(8) for _ in range(r.randint(0, 12))] + [(99, 3)]
    spans = [(k, s, s + r.randint(0, 9)) for k in range(8) for s in (r.randint(0, 60) for _ in range(r.randint(0, 8)))]
    got = M.nearest_spans(spark.createDataFrame(points, "k int, at int"), spark.createDataFrame(spans, "k int, start int, end int"), ["k"]).collect()
    want = [(k, at, min((max(s - at, at - e, 0) for j, s, e in spans if j == k), default=None)) for k, at in points]
    assert sorted(((x.k, x.at, x.distance) for x in got), key=str) == sorted(want, key=str)


def test_the_answer_without_a_version(spark):
    ids = spark.createDataFrame([("Mendeley Data", "10.17632/abc.1"), ("Mendeley Data", "10.17632/abd.2"), ("Zenodo", "10.5281/zenodo.1.2"), ("Synapse", "syn1"), ("GEO", "GSE1")], "repo string, id string")
    answers = spark.createDataFrame([("10.17632/abc", "bare"), ("10.17632/abd.2", "own"), ("10.17632/abd", "bare"), ("10.5281/zenodo.1", "no"), ("10.7303/syn1", "syn")], "doi string, text string")
    got = {r.id: r.text for r in L.doi_answers(ids, answers).collect()}
    assert got == {"10.17632/abc.1": "bare", "10.17632/abd.2": "own", "10.5281/zenodo.1.2": None, "syn1": "syn", "GSE1": None}
