"""Sharding, mixing and packing against their laws and brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.llm import mixing, packing, sharding

DOCS = "doc_id long, text string, source string"


# ---------------------------------------------------------------- sharding


def best_capacity(sizes, n):
    """The least largest sum of n contiguous runs, by dynamic programming."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(n):
        best = [min(max(best[i], ends[j] - ends[i]) for i in range(j + 1)) for j in range(len(sizes) + 1)]
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_minimax_cuts_are_best(seed):
    r = random.Random(seed)
    sizes = np.array([r.choice([0, 1, 5, 40, r.randint(0, 100)]) for _ in range(r.randint(0, 25))], dtype=np.int64)
    n = r.randint(1, 8)
    cuts = sharding.minimax_cuts(sizes, n)
    runs = np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(sizes)])[cuts]]))
    assert len(cuts) == n and runs.sum() == sizes.sum() and (np.diff(cuts) >= 0).all()
    assert runs.max(initial=0) == best_capacity(sizes, n)


def shards(spark, rows, n=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    text = F.coalesce("text", F.lit(""))
    return sharding.shard_by_size(docs, F.xxhash64(text), F.octet_length(text) + 16, [F.col("doc_id")], n)


def test_shards_keep_groups_and_number_slots(spark):
    rows = [(i, f"text {i % 37} " * (i % 11), "old") for i in range(1500)] + [(None, None, None), (5, None, "x"), (5, "", "x")]
    rows += [(2000 + i, "hot", "x") for i in range(1200)]
    out = shards(spark, rows)
    assert out.columns == ["doc_id", "text", "shard", "slot"] and dict(out.dtypes)["shard"] == "int"
    got = out.toPandas()
    assert len(got) == len(rows)
    assert got.groupby(got.text.fillna("")).shard.nunique().max() == 1
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_shards_of_an_empty_table(spark):
    assert shards(spark, []).count() == 0


# ---------------------------------------------------------------- mixing


def targets_by_rounds(sizes, copies=3.0):
    """Water filling by repeated rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > copies * sizes[s]]
        if not over:
            return held | share
        held |= {s: copies * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 10, None: 5}, {"b": 7}, {"a": 0, "b": 10}, {"é": 5, "z": 500, "A": 1, "b": 3, "c": 2, "d": 900}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(targets_by_rounds(sizes))


def test_mix_meets_targets_and_repeats(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", "c", None]), r.randint(0, 300), "x") for i in range(4000)]
    rows += [(9000, "hot", 10, "x")] * 40 + [(9000 + i, "hot", r.randint(1, 50), "x") for i in range(3000)] + [(None, "a", 7, "x"), (1, "b", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, target string")
    one = mixing.mix(docs).toPandas()
    two = mixing.mix(docs.repartition(7)).toPandas()
    key = ["source", "doc_id", "size", "copies"]
    assert len(one) == len(rows)
    assert one[key].fillna(-1).astype(str).sort_values(key).values.tolist() == two[key].fillna(-1).astype(str).sort_values(key).values.tolist()
    assert one.copies.between(0, 3).all()
    one["taken"] = one["size"] * one.copies
    g = one.groupby(one.source.fillna("none")).agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((g.taken - g.target).abs() <= 0.005 * g.target + 1).all()


def test_sample_equals_pareto_order(spark):
    r = random.Random(8)
    rows = [(i, "ab"[i % 2], r.choice([1, 5, 30, 200, 900])) for i in range(3000)] + [(5000 + i, "c", 50) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = {x.doc_id: (x.copies, x.target, x.source_size) for x in mixing.mix(docs).collect()}
    for name in "ab":
        own = [(i, n) for i, s, n in rows if s == name]
        _, target, total = got[own[0][0]]
        whole = int(target // total)
        rest = target - whole * total
        low, high = -60.0, 60.0
        odds = lambda n, c: math.exp(c) * (1 + 0.1 * int(math.log2(n + 1)))
        for _ in range(100):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(n * odds(n, mid) / (1 + odds(n, mid)) for _, n in own) < rest else (low, mid)
        ranked = []
        for i, n in own:
            u = ((xxhash_of(spark, i) >> 11) + 0.5) / 2**53
            ranked.append((u / (1 - u) / odds(n, low), i, n))
        taken = 0
        sure = []
        for _, i, n in sorted(ranked):
            if taken + n > rest:
                break
            taken += n
            sure.append(i)
        assert len(sure) > 100 and all(got[i][0] == whole + 1 for i in sure)
        others = [got[i][0] - whole for _, i, _ in sorted(ranked)[len(sure) :]]
        assert sum(others) <= mixing.NEXT and not any(others[mixing.NEXT + 1 :]) and set(others) <= {0, 1}


def xxhash_of(spark, number, memory={}):
    if not memory:
        memory.update({x.id: x.h & (2**64 - 1) for x in spark.range(3000).select("id", F.xxhash64("id", F.lit(9)).alias("h")).collect()})
    return memory[number]


def test_mix_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(empty).count() == 0
    nothing = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert {r.copies for r in mixing.mix(nothing).collect()} == {0}
    sized = mixing.sized_documents(spark.createDataFrame([(1, " a\tb\x0bc d ", "s"), (2, None, "s"), (3, "", "s")], DOCS))
    assert [r.size for r in sized.orderBy("doc_id").collect()] == [3, 0, 0]


# ---------------------------------------------------------------- packing


@pytest.mark.parametrize("seed", range(8))
def test_pack_loses_nothing_and_pads_nothing(seed):
    r = random.Random(seed)
    lengths = [r.choice([1, 2, r.randint(1, 300), r.randint(1, 6000), 2048, 4096]) for _ in range(r.randint(1, 400))]
    pieces = packing.pack(lengths)
    at: dict[int, int] = {}
    for d, start, n, _, _ in sorted(pieces):
        assert start == at.get(d, 0) and n > 0
        at[d] = start + n
    assert [at[i] for i in range(len(lengths))] == lengths
    fill: dict[int, int] = {}
    for _, _, n, s, o in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert o == fill.get(s, 0)
        fill[s] = o + n
    assert max(fill.values()) <= 2048 and all(f & (f - 1) == 0 for f in fill.values())


@pytest.mark.parametrize("seed", range(5))
def test_pack_equals_a_plain_search(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, 2047) for _ in range(r.randint(1, 500))]
    n = sum(lengths) // 2048
    used, cost, want, late = [0] * n, [0.0] * n, [], False
    for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start = 0
        while start < lengths[d] and not late:
            left = lengths[d] - start
            fit = [s for s in range(n) if 2048 - used[s] >= left]
            s = min(fit, key=lambda s: (cost[s], s)) if fit else max(range(n), key=lambda s: (2048 - used[s], -s)) if n else None
            late = s is None or used[s] == 2048
            if not late:
                take = min(left, 2048 - used[s])
                want.append((d, start, take, s, used[s]))
                used[s], cost[s], start = used[s] + take, cost[s] + packing.cost(take), start + take
    got = packing.pack(lengths)
    assert [p for p in got if p[3] < n] == want


def test_pack_balances_cost():
    r = random.Random(1)
    lengths = [r.randint(200, 1200) for _ in range(3000)]
    cost: dict[int, float] = {}
    for _, _, n, s, o in packing.pack(lengths):
        cost[s] = cost.get(s, 0) + packing.cost(n)
    full = sorted(cost.values())[11:]
    assert np.std(full) < 0.12 * np.mean(full)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_word_ids_equal_the_tokenizer(tokenizer):
    path, whole = tokenizer
    ids = packing.WordIds(path)
    r = random.Random(1)
    letters = "abZÀéßñ'sS tT.!1²½ªº\xadİ̇ Σσ x<|>$€\x1é日"
    texts = ["don't I'LL", "<|endoftext|> x <|endoftext|>y", "ΣΑΣ", "é ñandú", "日本 語", "", " \n"]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    for text, got in zip(texts, ids.of(texts), strict=True):
        assert got == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_each_character_in_three_contexts(tokenizer):
    path, whole = tokenizer
    ids = packing.WordIds(path)
    for first in range(0, 0x30000, 0x1000):
        texts = [t for c in range(first, first + 0x1000) if not 0xD800 <= c < 0xE000 for t in (chr(c), f"x{chr(c)}y", f"'s{chr(c)}{chr(c)} 1")]
        if texts:
            want = [np.array(x.ids, "<u4").tobytes() for x in whole.encode_batch(texts, add_special_tokens=False)]
            differ = [t for t, a, b in zip(texts, ids.of(texts), want, strict=True) if a != b]
            assert not differ


def test_packed_documents(spark, tokenizer):
    path, whole = tokenizer
    texts = {1: "a b c", 2: "", 3: None, 4: "word " * 9000, 5: "x"}
    rows = [(k, v, "s") for k, v in texts.items()] + [(5, "x", "s"), (None, "null id", "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("offset", F.lit("clash"))
    got = packing.pack_documents(docs, path).toPandas()
    for key, text in texts.items():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        mine = got[got.doc_id == key].sort_values("start").drop_duplicates("start")
        assert mine.length.sum() == len(ids) and set(mine.doc_tokens) == {len(ids)}
        for p in mine.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    assert got[got.doc_id == 5].length.sum() == 4 and got.doc_id.isna().sum() >= 1
    assert packing.pack_documents(docs.limit(0), path).count() == 0
