"""Repeated bytes against plain programs over all strings of 100 bytes."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from grantlens.llm import suffixes as suf
from grantlens.llm.registry import OP11_SQL

DOCS = "doc_id long, text string, spans string, key string"


def plain(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of texts in order."""
    seen, out = set(), []
    for text in texts:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            s = b[i : i + 100]
            if s in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i:x}é"[: r.randint(2, 6)] for i in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    stock = [prose(r.randint(25, 120)) for _ in range(8)]
    texts = []
    for _ in range(90):
        text = prose(r.randint(0, 60))
        for _ in range(r.randint(0, 3)):
            part = r.choice(stock)
            a = r.randint(0, len(part) // 2)
            text += part[a : a + r.randint(60, 60 + len(part))] + prose(r.randint(0, 20))
        texts.append(text)
    line = "A line that many documents have, in the middle of their own words, and nothing else at all."
    texts += [prose(8) + line + prose(8) for _ in range(60)]
    texts += ["x" * 350, "ab" * 400, "ab" * 90, "", None, "é" * 120, "the same text of its own " * 30, "y" * 99, "z" * 100, "z" * 100]
    texts += [texts[3]] * 12 + [prose(900) + stock[0] * 3]
    r.shuffle(texts)
    return texts


def reported(df):
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return [tuple(x)[1:] for x in sorted(df.collect(), key=lambda x: (x.doc_id is None, x.doc_id or 0))]


@pytest.mark.parametrize("seed, few, common", [(1, 2000, 4096), (2, 3, 4096), (3, 2000, 20), (4, 3, 20)])
def test_report_equals_brute_force(spark, monkeypatch, seed, few, common):
    """Also with anchors of over three stretches by digests, and with many common anchors."""
    monkeypatch.setattr(suf, "STRETCHES", few)
    monkeypatch.setattr(suf, "HOT", 1 << 40 if common == 20 else common)
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], DOCS).repartition(6)
    assert reported(suf.suffix_report(df)) == plain(texts)


def test_slices(monkeypatch):
    monkeypatch.setattr(suf, "SLICE", 64)
    text = corpus(5)[0].encode() * 5
    whole = {}
    for key, _, start, n in suf.stretches(text):
        for k, s, m in zip(key.tolist(), start.tolist(), n.tolist(), strict=True):
            whole |= {s + j: k for j in range(m)}
    monkeypatch.setattr(suf, "SLICE", 1 << 19)
    for key, _, start, n in suf.stretches(text):
        for k, s, m in zip(key.tolist(), start.tolist(), n.tolist(), strict=True):
            assert all(whole.pop(s + j) == k for j in range(m))
    assert not whole


@pytest.mark.parametrize("seed", range(12))
def test_longest_previous_factors(seed):
    r = np.random.default_rng(seed)
    text = r.integers(0, 1 + seed % 3, 160).astype(np.uint8)
    n = 12
    rows = np.lib.stride_tricks.sliding_window_view(text, n)
    starts = r.permutation(10 * len(rows))[: len(rows)]
    want = [max((next((k for k in range(n) if a[k] != b[k]), n) for b, t in zip(rows, starts) if t < s), default=0) for a, s in zip(rows, starts)]
    assert suf.longest_previous(rows, starts).tolist() == want


def test_digests_and_rolled():
    r = np.random.default_rng(3)
    part = r.integers(0, 256, 3000).astype(np.uint8)
    part[1000:1500] = part[100:600]
    assert (suf.digests(part, np.array([100, 1000]), np.array([500, 500])) == suf.digests(part[100:600], np.array([0]), np.array([500]))[0]).all()
    codes = suf.BYTE_CODES[0][part]
    for n in (1, 7, 40, 100):
        h = suf.rolled(codes, n, suf.BASES[0])
        assert len(h) == 3000 - n + 1 and h[100] == h[1000] and len(set(h.tolist())) > 2000 - n or n == 1


def test_rows_of_one_id_and_without(spark):
    text = "Some words that are long enough to be found again, as they fill more than a hundred bytes of a text. "
    df = spark.createDataFrame([(1, text, "", ""), (1, text, "", ""), (None, text + "More.", "", ""), (None, None, "", "")], DOCS)
    got = reported(suf.suffix_report(df))
    assert sorted(x[1] for x in got[:2]) == [0, len(text)] and sorted(x[1] for x in got[2:]) == [0, len(text)]


def test_empty_and_equal_to_sql(spark):
    assert suf.suffix_report(spark.createDataFrame([], DOCS)).collect() == []
    texts = corpus(8)
    c = duckdb.connect()
    c.execute("create table documents (doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    assert [x[1:] for x in sorted(c.execute(OP11_SQL).fetchall())] == plain(texts)
