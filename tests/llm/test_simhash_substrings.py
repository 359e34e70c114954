"""SimHash groups and repeated passages against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.llm import simhash, substrings
from grantlens.llm.common import components

DOCS = "doc_id long, text string, fp string"


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "a", "A b", "a b c", "Été ÀB c d", "a b c d e", "x y z " * 700, "w" * 100_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("flips, patterns", [(0, [2048, 2048, 16, 4]), (1, [10903, 10903, 121, 7])])
def test_perfect_codes(flips, patterns):
    for code, n in zip(simhash.CODES, patterns, strict=True):
        errors = simhash.coset_errors(*code, flips)
        assert all(len(e[0]) == 1 for e in errors)
        assert sum(len(p) for e in errors for p in e) == n


def test_anchors_are_code_words_within_reach():
    prints = np.array([random.Random(6).getrandbits(64) for _ in range(50)], dtype=np.uint64).view(np.int64)
    index, anchor = simhash.anchors(prints, 1)
    assert len(set(zip(index.tolist(), anchor.tolist()))) == len(index) and set(index.tolist()) == set(range(50))
    shift = 0
    over = np.zeros(len(index), np.int64)
    for length, radius, generator in simhash.CODES:
        block = anchor >> shift & ((1 << length) - 1)
        assert not simhash.syndrome(block, length, generator).any()
        apart = (block ^ (prints[index] >> shift)) & ((1 << length) - 1)
        over += np.maximum(0, [bin(int(x)).count("1") - radius for x in apart])
        shift += length
    assert shift == 64 and over.max() == 1


@pytest.mark.parametrize("threshold", [2, 4])
def test_links_equal_brute_force(spark, threshold):
    r = random.Random(5)
    prints = []
    for _ in range(60):
        base = r.getrandbits(64)
        prints.append(base)
        for _ in range(r.randint(0, 6)):
            x = base
            for b in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << b
            prints.append(x)
    prints = np.array(sorted(set(prints)), dtype=np.uint64).view(np.int64)
    frame = spark.createDataFrame([(int(x),) for x in prints], "fp long").repartition(4)
    got = {tuple(sorted((x.a, x.b))) for x in simhash.links(frame, threshold).collect()}
    u = prints.view(np.uint64)
    want = {tuple(sorted((int(prints[i]), int(prints[j])))) for i in range(len(u)) for j in range(i) if bin(int(u[i]) ^ int(u[j])).count("1") <= threshold}
    assert want and got == want


def test_first_of_groups(spark):
    r = random.Random(22)
    a, b = words(r, 200), words(r, 200)
    near = list(b)
    near[100] = "edited"
    rows = [(4, " ".join(a), "1"), (4, " ".join(b), "2"), (2, " ".join(near), "3"), (9, " ".join(a), "4"), (None, " ".join(words(r, 50)), "5"), (None, " ".join(b), "6"), (7, None, "7"), (8, "", "8")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    prints = [np.uint64(simhash.fingerprint(" ".join(x), 5)) for x in (b, near)]
    together = bin(int(prints[0] ^ prints[1])).count("1") <= 4
    got = {x.key for x in simhash.first_of_groups(docs).collect()}
    assert got == {"1", "3", "5", "7"} | (set() if together else {"2"})
    # without the test of shingles, texts whose fingerprints are near would do
    assert {x.key for x in simhash.first_of_groups(docs, similarity=1.0).collect()} == {"1", "2", "3", "5", "7"}
    assert simhash.first_of_groups(docs.limit(0)).count() == 0


def test_near_duplicate_groups(spark):
    rows = [(5, "same text here again", "x"), (2, "SAME text here again", "x"), (9, "quite another thing altogether", "x"), (7, None, "x"), (4, "", "x"), (4, "", "x"), (None, "same text here again", "x")]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(5, 2), (2, 2), (None, 2), (9, 9), (7, 4), (4, 4)}
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_near_copies_are_not_paired_at_each_anchor(spark, monkeypatch):
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)]
    for i in range(120):
        changed = list(words)
        for k in r.sample(range(400), 1 + i % 3 * 8):
            changed[k] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(changed))
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    prints = [simhash.fingerprint(x, 5) for x in texts]
    shingles = [simhash.shingles_of(x, 5) for x in texts]
    alike = lambda i, j: len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])
    first = {p: prints.index(p) for p in prints}
    near = [(i, j) for i in first.values() for j in first.values() if i < j and bin(prints[i] ^ prints[j]).count("1") <= 4]
    of = {i: i for i in first.values()}
    for i, j in near:
        if alike(i, j) and of[i] != of[j]:
            low, high = sorted((of[i], of[j]))
            of = {k: low if v == high else v for k, v in of.items()}
    asked = []
    real = simhash.confirmed
    monkeypatch.setattr(simhash, "confirmed", lambda edges, *a: asked.append(edges.count()) or real(edges, *a))
    got = simhash.near_duplicates(docs, "key", 5, 4, 0.8).collect()
    assert {x.key: x.component_id for x in got} == {i: of[first[p]] for i, p in enumerate(prints)}
    assert any(not alike(i, j) for i, j in near) and len(set(of.values())) < len(of)
    assert sum(asked) < 0.8 * len(near)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 500 + i) for i in range(30)] + [(1, None), (None, None)]
    parent = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    named = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    got = {(x.node, x.component) for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in named}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- passages


def words(r, n):
    return ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def test_planted_passages(spark):
    r = random.Random(8)
    passage, fuzzy = words(r, 60), words(r, 120)
    edited = [w if i % 17 else "changed" for i, w in enumerate(fuzzy)]
    short = words(r, 30)
    docs = {
        1: words(r, 80) + passage + words(r, 40),
        2: words(r, 10) + passage,
        3: passage + words(r, 300),
        4: words(r, 50) + fuzzy + words(r, 20),
        5: edited + words(r, 70),
        6: short + words(r, 90),
        7: words(r, 90) + short,
        8: words(r, 400),
        9: (lambda x: x + x)(words(r, 100)),
    }
    rows = [(k, " ".join(v), "x") for k, v in docs.items()] + [(10, None, "x"), (11, "", "x"), (None, " ".join(docs[1]), "x")]
    got = substrings.passages(spark.createDataFrame(rows, DOCS)).collect()
    by = {(x.doc_id, x.other_doc_id): x for x in got}
    assert set(by) == {(2, 1), (3, 1), (5, 4), (None, 1)}
    assert (by[None, 1].start_word, by[None, 1].end_word) == (0, 180)
    assert (by[2, 1].start_word, by[2, 1].end_word, by[2, 1].other_start, by[2, 1].other_end) == (10, 70, 80, 140)
    x = by[5, 4]
    assert x.start_word <= 1 and 119 <= x.end_word <= 120 and 0.9 < x.similarity < 1


def test_hot_passage_is_linear(spark):
    r = random.Random(9)
    passage = " ".join(words(r, 70))
    rows = [(i, " ".join(words(r, 20)) + " " + passage, "x") for i in range(300)]
    got = substrings.passages(spark.createDataFrame(rows, DOCS).repartition(5))
    assert sorted(x.doc_id for x in got.collect()) == list(range(1, 300))
    assert {x.other_doc_id for x in got.collect()} == {0}


def test_cutting_keeps_the_first_and_the_rest(spark):
    r = random.Random(10)
    passage, tail = " ".join(words(r, 60)), " ".join(words(r, 30))
    rows = [(1, passage, "a"), (2, "own start\n" + passage + "\t" + tail, "b"), (3, passage, "c"), (4, None, "d"), (5, " ", "e"), (None, passage, "f")]
    got = {(x.doc_id, x.text, x.fp) for x in substrings.without_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(1, passage, "a"), (2, "own start\n\t" + tail, "b"), (4, None, "d"), (5, " ", "e")}
    assert substrings.without_passages(spark.createDataFrame([], DOCS)).count() == 0


def test_texts_are_cut_once_by_one_python_worker(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, passage + f" u{i}") for i in range(3)], "doc_id long, text string")
    out = substrings.without_passages(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython", plan)) == 1
    # rows of the driver come by Arrow and not by Python workers of another kind
    assert "ExistingRDD" not in plan
    assert sorted(x.text for x in out.collect()) == [" u1", " u2", passage + " u0"]


def test_chains():
    a = np.array([0, 4, 9, 200, 205, 212])
    assert sorted(substrings.chains(a, a + 7)) == [(0, 14, 7, 21), (200, 217, 207, 224)]
    assert substrings.chains(np.array([0, 10]), np.array([10, 0])) in ([(0, 5, 10, 15), (10, 15, 0, 5)], [(10, 15, 0, 5), (0, 5, 10, 15)])


def test_long_text(spark):
    r = random.Random(11)
    text = " ".join(words(r, 30_000))
    docs = spark.createDataFrame([(1, text, "x"), (2, "more " + text, "x")], DOCS)
    got = substrings.passages(docs).collect()
    assert len(got) == 1 and got[0].n_words == 30_000


def test_ids_that_are_far_apart(spark):
    r = random.Random(12)
    text = " ".join(words(r, 60))
    docs = spark.createDataFrame([(-(2**40), text, "x"), (2**40, text, "x")], DOCS)
    assert [(x.doc_id, x.other_doc_id) for x in substrings.passages(docs).collect()] == [(2**40, -(2**40))]
    assert docs.select(F.count("*")).first()[0] == 2


def test_passages_next_to_other_shared_words(spark):
    r = random.Random(13)
    passage, three, one, two = words(r, 60), words(r, 3), words(r, 50), words(r, 50)
    docs = {
        1: words(r, 20) + passage + words(r, 20) + three + words(r, 30),
        2: words(r, 40) + passage + words(r, 20) + three + words(r, 10),
        3: words(r, 30) + three + words(r, 22) + passage,
        4: words(r, 15) + one + words(r, 28) + two + words(r, 9),
        5: words(r, 33) + one + words(r, 28) + two,
    }
    got = substrings.passages(spark.createDataFrame([(k, " ".join(v), "x") for k, v in docs.items()], DOCS)).collect()
    spans = {(x.doc_id, x.other_doc_id, x.start_word, x.end_word, x.other_start, x.other_end) for x in got}
    assert spans == {(2, 1, 40, 100, 20, 80), (3, 1, 55, 115, 20, 80), (5, 4, 33, 83, 15, 65), (5, 4, 111, 161, 93, 143)}


def test_parts_equal_brute_force():
    r = random.Random(14)
    for _ in range(200):
        i = j = 0
        blocks = []
        for _ in range(r.randint(1, 12)):
            n = r.randint(1, 40)
            blocks.append((i, j, n))
            i, j = i + n + r.randint(0, 20), j + n + r.randint(0, 20)
        some = False
        for x in range(len(blocks)):
            for y in range(x, len(blocks)):
                (a, b, _), (c, d, n) = blocks[x], blocks[y]
                la, lb = c + n - a, d + n - b
                some |= min(la, lb) >= 50 and sum(z[2] for z in blocks[x : y + 1]) >= 0.8 * max(la, lb)
        got = substrings.parts(blocks, 50, 0.8)
        assert bool(got) == some
        assert all(min(a1 - a0, b1 - b0) >= 50 and m >= 0.8 * max(a1 - a0, b1 - b0) for a0, a1, b0, b1, m in got)


def test_passages_of_which_earlier_documents_have_parts(spark):
    r = random.Random(15)
    passage, halves = words(r, 60), words(r, 70)
    docs = {
        1: words(r, 20) + passage[10:50] + words(r, 20),
        2: words(r, 20) + halves[:40] + words(r, 20),
        3: words(r, 20) + halves[30:] + words(r, 20),
        5: words(r, 33) + passage + words(r, 12),
        6: words(r, 14) + halves + words(r, 12),
        7: words(r, 90) + passage[10:50] + words(r, 12),
        8: words(r, 41) + halves + words(r, 25),
        9: words(r, 25) + passage + words(r, 41),
    }
    got = substrings.passages(spark.createDataFrame([(k, " ".join(v), "x") for k, v in docs.items()], DOCS)).collect()
    spans = {(x.doc_id, x.other_doc_id, x.start_word, x.end_word, x.other_start, x.other_end) for x in got}
    assert spans == {(9, 5, 25, 85, 33, 93), (8, 6, 41, 111, 14, 84)}


def test_rows_of_one_id_are_told_apart(spark):
    r = random.Random(16)
    shared, own, other = words(r, 70), words(r, 200), words(r, 90)
    rows = [(2, " ".join(own), "a"), (7, " ".join(shared), "b"), (8, " ".join(words(r, 9) + shared), "c"), (None, " ".join(shared), "d"), (2, " ".join(other), "e")]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    got = {x.fp: x.text for x in substrings.without_passages(docs).collect()}
    assert got == {"a": rows[0][1], "b": rows[1][1], "c": " ".join(rows[2][1].split()[:9]) + " ", "e": rows[4][1]}
    assert sorted(str(x.doc_id) for x in substrings.passages(docs).collect()) == ["8", "None"]


def test_columns_of_clashing_names(spark):
    r = random.Random(20)
    text = " ".join(words(r, 60))
    docs = spark.createDataFrame([(1, text, 5, "a b"), (2, "x " + text, 6, "c")], "doc_id long, text string, key long, `a.b` string").coalesce(1)
    got = substrings.without_passages(docs)
    assert got.dtypes == docs.dtypes and {(x.doc_id, x.text, x.key) for x in got.collect()} == {(1, text, 5), (2, "x ", 6)}


def test_seeds_do_not_depend_on_what_is_round_them():
    codes = np.random.default_rng(16).integers(0, 2**32, 300, dtype=np.uint32)
    h, at, long = substrings.seeds_of(codes)
    g, to, far = substrings.seeds_of(np.r_[codes[7:90], codes[100:200]])
    inner = {(x, y + 7) for x, y, z in zip(g.tolist(), to.tolist(), far.tolist(), strict=True) if y < 80 and not z}
    assert inner == {(x, y) for x, y, z in zip(h.tolist(), at.tolist(), long.tolist(), strict=True) if 7 <= y < 87 and not z}
    # 183 shared words, 0.28 / 4 of them begin a long seed, less those that reach over an end
    assert len(set(h[long].tolist()) & set(g[far].tolist())) >= 8
    assert all(len(x) == 0 for x in substrings.seeds_of(codes[:3]))


def covered_by_brute_force(texts: list[list[str]]) -> set[tuple[int, int]]:
    """(document, place) of words in stretches of 50 words and more of which 0.8 equal those of an earlier document.

    Stretches begin and end with equal words; there are no shifts within them.
    """
    out = set()
    for d in range(1, len(texts)):
        a = np.array(texts[d])
        for o in range(d):
            same = a[:, None] == np.array(texts[o])[None]
            for shift in range(-len(texts[o]) + 50, len(a) - 49):
                line = np.diagonal(same, -shift)
                if line.sum() < 40:
                    continue
                at = np.flatnonzero(line)
                seen = np.r_[0, np.cumsum(line)]
                for i in at:
                    ends = at[(at - i >= 49) & (seen[at + 1] - seen[i] >= 0.8 * (at + 1 - i))]
                    if len(ends):
                        out.update((d, x + max(0, shift)) for x in range(i, ends[-1] + 1))
    return out


def test_recall_against_brute_force(spark):
    r = random.Random(19)
    stock = [words(r, r.choice((30, 45, 60, 90))) for _ in range(20)]
    texts = []
    for _ in range(110):
        text = words(r, r.randint(0, 30))
        for _ in range(r.randint(1, 2)):
            part = list(r.choice(stock))
            begin = r.choice((0, 0, 10))
            for j in range(len(part)):
                if r.random() < r.choice((0, 0, 0.1, 0.15)):
                    part[j] = "new" + part[j]
            text += part[begin:] + words(r, r.randint(3, 30))
        texts.append(text)
    true = covered_by_brute_force(texts)
    docs = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(texts)], DOCS).coalesce(1)
    got = {(x.doc_id, i) for x in substrings.passages(docs).collect() for i in range(x.start_word, x.end_word)}
    documents = {d for d, _ in true}
    assert len(documents) > 50 and len({d for d, _ in true & got}) >= 0.9 * len(documents)
    assert len(true & got) >= 0.9 * len(true)


def test_each_word_changed_in_turn(spark):
    r = random.Random(21)
    rows = []
    for i in range(12):
        text = words(r, 200)
        rows += [(2 * i, " ".join(text), "x"), (2 * i + 1, " ".join("new" + x if j % (5 + i % 3) == 4 else x for j, x in enumerate(text)), "x")]
    got = substrings.passages(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(x.doc_id for x in got) == list(range(1, 24, 2)) and all(x.n_words >= 190 for x in got)


def test_recall_near_the_similarity(spark):
    r = random.Random(17)
    docs, planted = {}, {}
    for i in range(200):
        n = (50, 60, 75)[i % 3]
        passage = words(r, n)
        if i % 10 == 9:
            changed = set(range(4, n - 1, 5))
        else:
            changed = set(r.sample(range(1, n - 1), round(n * (0.2, 0.18, 0.15)[i % 9 // 3])))
        before, after = r.randint(0, 60), r.randint(0, 60)
        docs[i] = words(r, r.randint(0, 60)) + passage + words(r, r.randint(0, 60))
        docs[1000 + i] = words(r, before) + [x if j not in changed else "new" + x for j, x in enumerate(passage)] + words(r, after)
        planted[1000 + i] = (i, before, before + n)
    got = substrings.passages(spark.createDataFrame([(k, " ".join(v), "x") for k, v in docs.items()], DOCS)).collect()
    assert {(x.doc_id, x.other_doc_id) for x in got} <= {(k, v[0]) for k, v in planted.items()}
    found = {x.doc_id for x in got if min(x.end_word, planted[x.doc_id][2]) - max(x.start_word, planted[x.doc_id][1]) >= 45}
    assert len(found) >= 0.95 * len(planted)


def test_texts_that_repeat_themselves(spark):
    r = random.Random(18)
    line = words(r, 13)
    docs = [(1, " ".join(line * 20), "x"), (2, " ".join(line * 25), "x")]
    got = sorted(substrings.passages(spark.createDataFrame(docs, DOCS)).collect(), key=lambda x: x.start_word)
    assert got and all(x.start_word < y.start_word and x.end_word < y.end_word for x, y in zip(got, got[1:], strict=False))
    assert all(x.end_word < y.start_word for x, y in zip(got, got[2:], strict=False))


def test_all_seeds_are_kept():
    codes = np.random.default_rng(23).integers(0, 2**32, 3000, dtype=np.uint32)
    h, at, long = substrings.seeds_of(codes)
    assert sorted(at[~long].tolist()) == list(range(2997)) and len(set(h.tolist())) == len(h)
    # any 50 words hold the 29 of a long seed which is kept in them, whatever is round them
    for i in range(0, 2900, 50):
        g, _, far = substrings.seeds_of(np.r_[codes[::-1][:77], codes[i : i + 50], codes[::-1][100:150]])
        assert set(h[long & (at >= i) & (at <= i + 21)].tolist()) & set(g[far].tolist())
    h, at, long = substrings.seeds_of(np.tile(codes[:2], 100))
    assert sorted(at[~long].tolist()) == list(range(197))


def test_every_passage_of_which_each_fifth_word_differs(spark):
    r = random.Random(24)
    rows, want = [], set()
    for i in range(150):
        passage = words(r, 50)
        changed = [x if j % 5 != 2 + i % 2 else "new" + x for j, x in enumerate(passage)]
        rows += [(i, " ".join(words(r, r.randint(0, 40)) + passage), "x"), (1000 + i, " ".join(changed + words(r, r.randint(0, 40))), "x")]
        want.add((1000 + i, i))
    got = {(x.doc_id, x.other_doc_id) for x in substrings.passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == want


def test_texts_of_a_few_words_over_and_over(spark):
    texts = {0: "ho", 2: "la lo", 4: "ta te ti", 6: "ma me mi mo"}
    rows = []
    for i, text in texts.items():
        rows += [(i, f"a{i} " + f"{text} " * 60, "x"), (i + 1, f"b{i} c{i} " + f"{text} " * 80, "x")]
    got = substrings.passages(spark.createDataFrame(rows, DOCS)).collect()
    covered = {}
    for x in got:
        covered.setdefault((x.doc_id, x.other_doc_id), set()).update(range(x.start_word, x.end_word))
    assert set(covered) == {(i + 1, i) for i in texts}
    assert all(len(v) >= 60 * len(texts[k[1]].split()) for k, v in covered.items())
