"""WARC round trips and near-duplicate vectors against brute force."""

import gzip
import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.llm import neardup_vectors as nv
from grantlens.llm import warc
from grantlens.llm.common import scratch

PAGES = "page_id long, url string, html string, payload string"


def test_round_trip(spark):
    big, other = "<p>ä</p>" * 40, "x" * 100
    rows = [(3, "http://a/ b\n", big, "c"), (1, "http://b", big, "c"), (1, "http://b", big, "c"), (2, None, "short", "c"), (4, "u", "short", "c"), (5, "u", None, "c"), (6, "u", "", "c"), (7, "u", "x" * 99, "c"), (8, "u", other, "c"), (None, "u", other, "c")]
    path = scratch(spark, "warc")
    warc.write_warc(warc.page_records(spark.createDataFrame(rows, PAGES).repartition(3)), path)
    got = warc.read_warc(spark, path, digest=True).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.record_id, []).append(r)
    assert [r.record_type for r in by["urn:page:1"]] == ["response", "response"]
    three = by["urn:page:3"][0]
    assert (three.record_type, three.refers_to, three.payload_bytes) == ("revisit", "urn:page:1", len(big.encode())) and not three.payload
    assert three.payload_digest == "sha256:" + hashlib.sha256(big.encode()).hexdigest()
    assert three.target_uri == "http://a/%20b%0A" and by["urn:page:2"][0].target_uri is None
    assert by["urn:page:1"][0].payload == big.encode() and by["urn:page:1"][0].payload_sha256 == hashlib.sha256(big.encode()).hexdigest()
    assert by["urn:page:4"][0].record_type == "response" and by["urn:page:5"][0].payload_bytes == 0
    assert by["urn:page:null"][0].refers_to == "urn:page:8"


def test_no_pages(spark):
    path = scratch(spark, "warc")
    warc.write_warc(warc.page_records(spark.createDataFrame([], PAGES)), path)
    assert warc.read_warc(spark, path).count() == 0


def test_filters_are_pushed(spark):
    rows = [(i, f"http://h{i % 3}/x", "y" * 200 if i % 2 else f"{i} " * 100, "c") for i in range(50)]
    path = scratch(spark, "warc")
    warc.write_warc(warc.page_records(spark.createDataFrame(rows, PAGES)), path)
    df = warc.read_warc(spark, path).where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://h1"))
    got = df.collect()
    assert {r.record_type for r in got} == {"revisit"} and all(r.target_uri.startswith("http://h1") for r in got)
    reader = warc.WarcReader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert reader.tests == [("record_type", "in", ("revisit",))] and [f.attribute for f in left] == [("payload_bytes",)]
    assert df.count() == len([1 for i in range(50) if i % 2 and i != 1 and i % 3 == 1])


def test_unwanted_payloads_are_not_read():
    class Watched:
        def __init__(self, data):
            self.data, self.at, self.read_bytes = data, 0, 0

        def seek(self, n):
            self.at = n

        def read(self, n):
            out = self.data[self.at : self.at + n]
            self.at += len(out)
            self.read_bytes += len(out)
            return out

    import random

    noise = random.Random(1).randbytes(300_000)
    one = warc.record("response", "urn:page:1", "http://a", "2020-01-01T00:00:00Z", "0", noise, len(noise), None)
    f = Watched(b"".join(warc.member(one) for _ in range(20)))
    assert list(warc.Archive(f, len(f.data), 0, len(f.data)).records(lambda h: False)) == []
    assert f.read_bytes < 0.05 * len(f.data)


@pytest.mark.parametrize("kind", ["skip", "plain_gzip", "text"])
@pytest.mark.parametrize("split", [1000, 7777, 10**9])
def test_any_file_in_any_ranges(spark, tmp_path, kind, split):
    make = {"skip": warc.member, "plain_gzip": gzip.compress, "text": bytes}[kind]
    payloads = [b"WARC/1.1 in a payload\r\n\r\nWARC/1.1\r\n" + bytes([65 + i]) * (i * 300) for i in range(30)]
    data = b"".join(make(warc.record("response", f"urn:page:{i}", "http://a", "2020-01-01T00:00:00Z", "0", p, len(p), None)) for i, p in enumerate(payloads))
    name = tmp_path / ("a.warc" if kind == "text" else "a.warc.gz")
    name.write_bytes(data)
    got = {r.record_id: bytes(r.payload) for r in warc.read_warc(spark, str(tmp_path), split_bytes=split).collect()}
    assert got == {f"urn:page:{i}": p for i, p in enumerate(payloads)}


def test_files_that_no_commit_lists_are_not_read(spark):
    path = scratch(spark, "warc")
    warc.write_warc(warc.page_records(spark.createDataFrame([(1, "u", "a", "c")], PAGES)), path)
    local = path.removeprefix("file://")
    first = next(f for f in os.listdir(local) if f.endswith(".gz"))
    with open(f"{local}/{first}", "rb") as f, open(f"{local}/part-lost-attempt.warc.gz", "wb") as g:
        g.write(f.read())
    assert warc.read_warc(spark, path).count() == 1


# ---------------------------------------------------------------- vectors

VECTORS = "vec_id long, embedding array<float>, label int, node string"


def brute(rows):
    usable = [(i, np.array(v, dtype=float), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    links = {i: 0 for i, *_ in rows}
    parent = {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(usable)):
        for b in range(a):
            (i, x, lx), (j, y, ly) = usable[a], usable[b]
            if lx == ly and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in links}


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(4)
    rows = []
    for c in range(40):
        base = r.normal(size=16)
        for _ in range(int(r.integers(1, 6))):
            rows.append((base + r.normal(size=16) * 0.2).astype(np.float32).tolist())
    big = r.normal(size=16)
    rows += [(big + r.normal(size=16) * 0.1).astype(np.float32).tolist() for _ in range(60)]
    data = [(i, v, i % 2 if i < 100 else 7) for i, v in enumerate(rows)]
    data += [(1000 + i, rows[0], 0) for i in range(5)]
    data += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None, *rows[0][1:]], 0), (2004, rows[0], None), (2005, [], 0), (2006, [float("inf"), *rows[0][1:]], 0), (2007, [x * 3 for x in rows[0]], 0)]
    df = spark.createDataFrame([(*x, "clash") for x in data], VECTORS).repartition(5)
    got = {x.vec_id: (x.n_links, x.component_id) for x in nv.near_duplicates(df).collect()}
    want = brute(data)
    assert got == want
    assert max(n for n, _ in got.values()) >= 50


def test_vector_edges(spark):
    assert nv.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(None, [1.0, 0.0], 1, "x"), (2, [1.0, 0.0], 1, "x"), (2, [1.0, 0.0], 1, "x")]
    got = sorted((x.vec_id or 0, x.n_links, x.component_id, x.kept) for x in nv.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect())
    assert got == [(0, 0, None, False), (2, 1, 2, True), (2, 1, 2, True)]


def test_recall_of_the_lists(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(700, 32))
    x = np.concatenate([base, base[:300] + r.normal(size=(300, 32)) * 0.22]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(x)], VECTORS)
    classes = nv.vector_classes(df)
    lists, length, audited = nv.neighbour_graph(classes)
    assert audited >= 0.99 and length == 32
    found = lists.where(F.col("cos") >= 0.93).count()
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(1, keepdims=True))
    true = int(((u @ u.T) >= 0.93).sum() - len(u))
    assert true > 100 and found >= 0.95 * true


def test_the_audit_counts_links_between_dense_components(spark):
    """Two crowds whose lists are full, and links between them that no list holds."""
    r = np.random.default_rng(4)
    base = r.normal(size=16)
    base /= np.linalg.norm(base)
    side = r.normal(size=16)
    side -= side @ base * base
    side /= np.linalg.norm(side)
    # within a crowd all are close; between them only some pairs are
    x = [base + 0.12 * s * side + 0.02 * r.normal(size=16) for s in (-1, 1) for _ in range(60)]
    x += [base + 2.0 * side + 0.01 * r.normal(size=16)]
    rows = [(i, 1, [float(v) for v in y], 1) for i, y in enumerate(x)]
    classes = spark.createDataFrame(rows, "node long, label long, vec array<float>, copies long")
    unit = np.array([v for _, _, v, _ in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cos = unit @ unit.T
    true = {(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and cos[i, j] >= nv.THRESHOLD}
    across = {(i, j) for i, j in true if (i < 60) != (j < 60)}
    assert across
    kept = []
    for i in range(len(rows)):
        near = sorted((j for j in range(len(rows)) if (i, j) in true - across), key=lambda j: -cos[i, j])[: nv.LONGER[-1]]
        kept += [(i, j, float(cos[i, j])) for j in near]
    lists = spark.createDataFrame(kept, "u long, v long, cos double")
    found = nv.recall(lists, classes, nv.LONGER[-1], 1)
    assert found == pytest.approx(1 - len(across) / len(true), abs=1e-9)
    whole = spark.createDataFrame([*kept, (0, 60, 0.95), (60, 0, 0.95)], "u long, v long, cos double")
    assert nv.recall(whole, classes, nv.LONGER[-1], 1) == 1.0
