"""Divergence of sources against its SQL over all terms by all sources."""

import random

import duckdb
import pytest

from grantlens.llm import divergence as div
from grantlens.llm.registry import OP13_SQL

DOCS = "doc_id long, text string, lang string, source string, part string, value string, n string"


def by_sql(rows):
    import pandas as pd

    c = duckdb.connect()
    frame = pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"]).astype("object")  # noqa: F841
    c.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    if rows:
        c.executemany("insert into documents values (?, ?, ?, ?)", [r[:4] for r in rows])
    return sorted(c.execute(f"select lang, source, part, item, value, rank from ({OP13_SQL})").fetchall())


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def corpus():
    r = random.Random(9)
    words = [f"{a}{b}" for a in ("An", "été", "co", "ſt", "K") for b in ("dal", "fer", "É", "zo", "m", "qu", "İx")]
    rows = []
    for i in range(600):
        lang, source = r.choice(["a", "a", "b", None]), r.choice(["hot"] * 6 + ["s1", "S2", "é", None])
        own = words[: 12 + 3 * len(source or "")]
        text = " ".join(r.choice(own) + r.choice(["", ".", "1", "\n", "'s", "—"]) for _ in range(r.randint(0, 30)))
        rows.append((i % 500, text, lang, source, "x", "y", "z"))
    rows += [(None, None, "a", "never a term", "", "", ""), (1, "", "c", "s1", "", "", ""), (1, "some word", "c", "s2", "", "", "")]
    rows += [(7, "Same row. " * 3, "a", "s1", "", "", "")] * 12
    return rows


@pytest.mark.parametrize("bits", [64, 4, 1])
def test_equals_its_sql(spark, bits):
    """With few bits most digests collide, and terms are told apart by their strings."""
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    assert found(div.divergence(df, bits=bits)) == by_sql(rows)


def test_hashes_are_of_terms_alone(monkeypatch):
    data = "Été, the_The THE; a\x00b 中文x ".encode() * 50 + b"w" * 3000
    found = div.Terms(data)
    names = [found.data[s:e] for s, e in zip(found.start, found.end)]
    assert names == div.terms_of(data)
    for which in (0, 1):
        h = found.hashes(which)
        assert len({*zip(names, h.tolist())}) == len(set(names)) == len(set(h.tolist()))
        monkeypatch.setattr(div, "PIECE", 7)
        assert (found.hashes(which) == h).all()
        assert (div.Terms(b"--" + data).hashes(which) == h).all()


def test_small_batches(spark, monkeypatch):
    monkeypatch.setattr(div, "HELD", 50)
    rows = corpus()[:200]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    assert found(div.divergence(df, min_docs=10)) == by_sql(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_shuffled_groups(spark, monkeypatch):
    monkeypatch.setattr(div, "FEW_GROUPS", 3)
    rows = corpus()
    assert found(div.divergence(spark.createDataFrame(rows, DOCS))) == by_sql(rows)


def test_ties_go_by_their_strings(spark):
    rows = [(i, " ".join(f"w{chr(97 + k)}" for k in range(25)) if i % 2 else "wz " * 25, "l", "s" if i % 2 else "t", "", "", "") for i in range(40)]
    got = found(div.divergence(spark.createDataFrame(rows, DOCS)))
    assert got == by_sql(rows) and [x[3] for x in got if x[1] == "s" and x[2] == "term"] == [f"w{chr(97 + k)}" for k in range(10)]


def test_edges(spark):
    assert found(div.divergence(spark.createDataFrame([], DOCS))) == []
    rows = [(i, None, "l", f"s{i % 3}", "", "", "") for i in range(9)]
    assert found(div.divergence(spark.createDataFrame(rows, DOCS))) == by_sql(rows)
    rows = [(i, "Word " * 300_000 if i == 1 else "word", "l", f"s{i % 3}", "", "", "") for i in range(12)]
    assert found(div.divergence(spark.createDataFrame(rows, DOCS))) == by_sql(rows)
