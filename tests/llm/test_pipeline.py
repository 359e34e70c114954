"""The corpus pipeline against a plain Python run of its decisions on a small planted corpus."""

import random

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(70)
    rows, toxic = [], {}
    for i in range(240):
        bad = i % 6 == 0
        body = text(r.randint(30, 120))
        rows.append([i, ("you idiot stupid moron scum " if bad else "") + body, "en", f"s{i % 4}", 0])
        toxic[i] = int(bad)
    rows[11][1] = rows[7][1]
    rows[13][1] = rows[13][1] + " " + passage
    rows[17][1] = passage + " " + rows[17][1]
    rows += [[900, None, None, None, None], [901, "", "en", "s1", 0], [None, text(20), "en", "s2", 0]]
    for x in rows:
        x[4] = len(x[1] or "")
    folder = str(tmp_path_factory.mktemp("corpus"))
    clashes = [(*x, "a", "b", "c", "d") for x in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, target string, copies string"
    spark.createDataFrame(clashes, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, v) for k, v in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, toxic, passage


def test_stages(spark, corpus):
    folder, rows, toxic, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substrings", "mixing", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out.cache()
        seen[name] = docs.collect()
    ids = lambda name: {x.doc_id for x in seen[name]}
    assert ids("toxicity") == {x[0] for x in rows if not toxic.get(x[0])}
    assert ids("simhash") == ids("toxicity") - {11, 901}
    cut = {x.doc_id: x for x in seen["substrings"]}
    assert set(cut) == ids("simhash")
    assert passage in cut[13].text and passage not in cut[17].text and cut[17].n_chars == len(cut[17].text)
    assert all(x.text == dict((a, b) for a, b, *_ in rows)[x.doc_id] for x in seen["substrings"] if x.doc_id != 17)
    taken = {}
    for x in seen["mixing"]:
        taken[x.source] = taken.get(x.source, 0) + len((x.text or "").split())
    sizes = {}
    for x in seen["substrings"]:
        sizes[x.source] = sizes.get(x.source, 0) + len((x.text or "").split())
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.1 * sum(sizes.values())
    assert {x.doc_id for x in seen["packing"]} == ids("mixing")


def test_run(spark, corpus):
    out = corpus_pipeline.run(spark, corpus[0])
    fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert out.count() and fill.where("n > 2048").count() == 0
