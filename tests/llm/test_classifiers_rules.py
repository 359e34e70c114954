"""Toxicity, quality network and quality rules: held-out accuracy, gradients, exact bounds, edges."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.llm import quality_cnn as cnn
from grantlens.llm import quality_rules as rules
from grantlens.llm import toxicity as tox

DOCS = "doc_id long, text string, score string"
R = random.Random(2)
SYLLABLES = "an ber con der ent fa gu hin ion ju ka lo mi nu ort".split()


def prose(n, extra=()):
    out = ["".join(R.choice(SYLLABLES) for _ in range(R.randint(1, 4))) for _ in range(n)]
    for w in extra:
        out[R.randrange(n)] = w
    return " ".join(out).capitalize() + "."


@pytest.fixture(scope="module")
def toxic(spark):
    rows = []
    for i in range(900):
        bad = i % 5 == 0
        words = [R.choice(["zarkul", "zarkulon", "zarkuleth"]) + R.choice(SYLLABLES) for _ in range(4)] if bad else []
        rows.append((i, prose(R.randint(20, 200), words), int(bad)))
    docs = spark.createDataFrame([(a, b, "clash") for a, b, _ in rows], DOCS)
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int")
    return rows, docs, labels


def test_toxicity_learns_terms(spark, toxic):
    rows, docs, labels = toxic
    out = tox.toxicity(docs, labels.where(~tox.in_fold(4, 2)), sample=300)
    assert out.columns == ["doc_id", "text", "score"]
    got = {r.doc_id: r.score for r in out.withColumn("held", tox.in_fold(4, 2)).where("held").collect()}
    truth = {a: c for a, _, c in rows}
    assert len(got) > 100
    assert all((s >= 0.3) == (truth[i] == 1) for i, s in got.items())


def test_toxicity_edges(spark, toxic):
    rows, docs, labels = toxic
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "You idiot, you stupid clown, you are pathetic scum", "x"), (3, "zarkulan " * 200_000, "x")], DOCS)
    got = {r.doc_id: r.score for r in tox.toxicity(odd, labels).collect()}
    assert got[1] == got[2] < 0.3 and all(0 <= x <= 1 for x in got.values())
    model = tox.train(docs, labels)
    scored = {r.doc_id: r.score for r in tox.score(odd, model, ["doc_id"]).collect()}
    assert scored[1] == scored[2] < 0.3 and scored[3] > 0.5
    none = tox.toxicity(odd, labels.limit(0))
    assert {r.doc_id: r.score >= 0.3 for r in none.collect()}[None]
    assert tox.toxicity(odd.limit(0), labels).count() == 0


def test_label_model_finds_accuracies_and_doubled_voters():
    r = np.random.default_rng(0)
    y = (r.random(4000) < 0.2).astype(int)
    hit = lambda p1, p0: (r.random(4000) < np.where(y == 1, p1, p0)).astype(float)
    a = hit(0.8, 0.02)
    votes = np.column_stack([a, np.where(r.random(4000) < 0.97, a, 1 - a), hit(0.6, 0.05), hit(0.3, 0.3)])
    noisy = np.where(r.random(4000) < 0.05, 1 - y, y)
    model = tox.LabelModel()
    post = model.fit(votes, noisy, 0.5, np.ones(4000))
    assert ((post > 0.5) == (y == 1)).mean() >= (noisy == y).mean()
    block = next(b for b in model.blocks if 0 in b)
    assert 1 in block and 3 not in block
    # the prior, and how far people's labels can be trusted, come from the votes
    assert abs(model.prior - 0.2) < 0.03
    assert abs(model.tables[-1][2] - np.log(0.95 / 0.05)) < 0.6


def test_label_model_with_few_labels():
    r = np.random.default_rng(2)
    y = (r.random(6000) < 0.15).astype(int)
    hit = lambda p1, p0: (r.random(6000) < np.where(y == 1, p1, p0)).astype(float)
    votes = np.column_stack([hit(0.7, 0.02), hit(0.6, 0.03), hit(0.5, 0.02), hit(0.2, 0.2)])
    labels = np.where(r.random(6000) < 0.03, y, -1)
    model = tox.LabelModel()
    post = model.fit(votes, labels, 0.3, np.ones(6000))
    assert abs(model.prior - 0.15) < 0.03
    # by brute force: the posterior of independent voters of the true rates
    odds = np.log(0.15 / 0.85) + sum(
        np.where(votes[:, i] == 1, np.log(p / q), np.log((1 - p) / (1 - q))) for i, (p, q) in enumerate([(0.7, 0.02), (0.6, 0.03), (0.5, 0.02)])
    )
    free = labels < 0
    assert np.abs(post - 1 / (1 + np.exp(-odds)))[free].mean() < 0.03


def test_linear_fit():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 3))
    p = 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] + 0.5)))
    w = tox.fit_linear(x, p, np.ones(2000), ridge=1e-8)
    assert np.allclose(w, [2, -1, 0, 0.5], atol=0.01)


def test_fold(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in [*range(40), None]], "doc_id long").withColumn("f", tox.in_fold(4, 2)).collect()
    assert all(r.f == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


# ---------------------------------------------------------------- quality network


def test_slices_equal_the_whole(monkeypatch):
    text = "the cat the cat sat " * 1500 + "".join(R.choice("abcé ") for _ in range(20_000))
    codes, copies = cnn.cut_chunks(text)
    b = cnn.byte_array(text)
    marks = cnn.repeats(b)
    for i, s in enumerate(cnn.chunks_of(len(b))):
        own = b[s : s + cnn.CHUNK]
        assert (codes[i][: len(own)] == own).all() and (codes[i][len(own) :] == 256).all()
        assert (copies[i][: len(own)] == marks[s : s + cnn.CHUNK]).all()
    monkeypatch.setattr(cnn, "SLICE", 7)
    again = cnn.cut_chunks(text)
    assert (again[0] == codes).all() and (again[1] == copies).all()
    assert cnn.cut_chunks("")[0].shape == (1, cnn.CHUNK)


def test_gradients_equal_differences():
    net = cnn.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(3)
    codes = r.integers(0, 257, (4, 2, cnn.CHUNK)).astype(np.int16)
    copy = (r.random(codes.shape) < 0.2).astype(np.float64)
    y, weight = np.array([0, 1, 1, 0.0]), np.ones(4)

    def loss():
        f = net.pooled(codes.reshape(8, -1), copy.reshape(8, -1))[0].reshape(4, 2, -1)
        z, _ = net.head(np.concatenate([f.mean(1), f.max(1)], axis=1))
        return float((np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z).mean())

    got = net.gradients([[x] for x in zip(codes, copy, strict=True)], y, weight)
    halves = [[(c[:1], k[:1]), (c[1:], k[1:])] for c, k in zip(codes, copy, strict=True)]
    assert all(np.allclose(g, got[k]) for k, g in net.gradients(halves, y, weight).items())
    for k, g in got.items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = net.p[k][i], 1e-5
        net.p[k][i] = old + step
        up = loss()
        net.p[k][i] = old - step
        down = loss()
        net.p[k][i] = old
        assert (up - down) / (2 * step) == pytest.approx(g[i], rel=2e-3), k


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000, 100_001])
def test_chunks_cover_all_bytes(n):
    starts = cnn.chunks_of(n)
    covered = np.zeros(starts[-1] + cnn.CHUNK, bool)
    for s in starts:
        covered[s : s + cnn.CHUNK] = True
    assert covered.all() and len(covered) >= n
    assert all(b - a <= cnn.CHUNK - cnn.WIDTH for a, b in zip(starts, starts[1:], strict=False))


def test_repeats():
    assert cnn.repeats(np.frombuffer(b"the cat the cat!", np.uint8)).astype(int).tolist() == [0] * 12 + [1, 1, 1, 0]


def test_quality_network(spark):
    rows = []
    for i in range(500):
        good, text = i % 4 != 0, prose(R.randint(30, 400))
        if not good:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "*** "), " ".join(w for w in text.split()[:20] for _ in range(9))][i % 3]
        rows.append((i, text, int(good)))
    docs = spark.createDataFrame([(a, b, "x") for a, b, _ in rows], DOCS)
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, quality int").where(~tox.in_fold(3, 1))
    model = cnn.train(docs, labels)
    got = {r.doc_id: r.score for r in cnn.score(docs.where(tox.in_fold(3, 1)), model, ["doc_id"]).collect()}
    truth = {a: c for a, _, c in rows}
    assert sum((s >= 0.5) == (truth[i] == 1) for i, s in got.items()) >= 0.97 * len(got)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "ab " * 300_000, "x"), (None, "é", "x")], DOCS)
    scores = {r.doc_id: r.score for r in cnn.score(odd, model, ["doc_id"]).collect()}
    assert scores[1] == scores[2] and all(0 <= s <= 1 for s in scores.values())
    assert cnn.quality(odd, labels.limit(0)).select("score").distinct().first()[0] == 0.5
    assert cnn.score(odd.limit(0), model, ["doc_id"]).count() == 0


@pytest.mark.parametrize("kinds", ["ll", "lls", "sl"])
def test_quality_of_long_labelled_texts(spark, monkeypatch, kinds):
    """Texts of 10 MB, in each class or in one beside short ones, are learned from like others."""
    monkeypatch.setattr(cnn, "STEPS", 60)
    long, short = 10 << 20, 4000
    rows = []
    for i, kind in enumerate(kinds * (1 if "ll" in kinds else 6)):
        n = (long if i < 2 else short) if kind == "l" else short
        good = kind == "l" if "ll" not in kinds else i % 2 == 1
        text = prose(400) if good else prose(400).replace(" ", "*** ")
        rows.append((i, (text * (n // len(text) + 1))[:n], int(good)))
    docs = spark.createDataFrame([(a, b, "x") for a, b, _ in rows], DOCS).repartition(4)
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in cnn.score(docs, cnn.train(docs, labels), ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == (c == 1) for i, _, c in rows)


# ---------------------------------------------------------------- quality rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    r = random.Random(7)
    texts = [None, "", " ", "\n\n", "a", "a a a", "a a a a", "a b c a b c", "x y z\nx y z\n\nx y z \n", "é ü 𝒳 #|<", "a\x0bb\x0cc\rd\te", "a\xa0b c"]
    texts += ["".join(r.choice("ab \n\t#é") for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += [" ".join(r.choice("abcd") for _ in range(r.randint(1, 80))) for _ in range(100)] + ["one two three " * 20_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOCS)
    got = {x.doc_id: (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in rules.measures(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n, alpha, delta", [(0, 0.02, 0.05), (50, 0.02, 0.01), (500, 0.02, 0.003), (3000, 0.01, 0.001), (40, 0.5, 0.5)])
def test_exact_bound(n, alpha, delta):
    def cdf(k):
        return sum(math.comb(n, i) * alpha**i * (1 - alpha) ** (n - i) for i in range(k + 1))

    k = rules.most_rejections(n, alpha, delta)
    assert (k < 0 or cdf(k) <= delta) and (k >= n or cdf(k + 1) > delta)


def test_rules_keep_good_documents_and_reject_junk(spark):
    rows = []
    for i in range(3600):
        good, text = i % 3 != 0, prose(R.choice([60, 200, 700]))
        rows.append((i, text if good else text.replace(" ", "*** "), int(good)))
    docs = spark.createDataFrame([(a, b, "x") for a, b, _ in rows], DOCS)
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in rules.quality_rules(docs, labels).collect()}
    assert not any(got[a] for a, _, c in rows if not c)
    # cutoffs are tightened until the bound binds: some good documents go, and not more than the bound allows
    good = [(len(b.split()), got[a]) for a, b, c in rows if c]
    for low, high in ((0, 150), (150, 600), (600, 10**6)):
        kept = [k for n, k in good if low < n <= high]
        assert kept and sum(kept) >= (1 - rules.ALPHA) * len(kept)
    few = rules.quality_rules(docs, labels.limit(0)).where("NOT kept").count()
    assert few == 0
    assert rules.quality_rules(docs.limit(0), labels).count() == 0


def test_steps_of_cutoffs(spark):
    names = [r for r, _ in rules.cutoffs()]
    assert names[: len(rules.RULES)] == list(rules.RULES) and len(names) == len(rules.RULES) * rules.LEVELS
    values = [{r: v for r in rules.RULES} for v in (0.0, 0.001, 0.4, 5.0)] + [dict.fromkeys(rules.RULES, 0.0) | {"bang_rate": 2.0 * rules.TIGHTER**3}]
    frame = spark.createDataFrame([tuple(v.values()) for v in values], ", ".join(f"{r} double" for r in rules.RULES))
    got = [x.step for x in frame.select(rules.first_rejection().alias("step")).collect()]
    want = [next((i for i, (r, c) in enumerate(rules.cutoffs(), 1) if v[r] >= c), None) for v in values]
    assert got == want and got[0] is None and got[3] == 1 and got[4] == 3 * len(rules.RULES) + 4


def test_thresholds_by_hand(spark):
    r = random.Random(3)
    rows = [(r.randint(0, 1), r.choice([None, r.randint(1, 160)]), False, 1) for _ in range(900)] + [(2, 5, False, 1)] * 20 + [(0, 1, True, 1), (0, 1, False, 0)]
    got = rules.thresholds(spark.createDataFrame(rows, "stratum int, step int, base_failed boolean, quality int"), 0.3, 0.05)
    for stratum in (0, 1, 2):
        steps = [x[1] for x in rows if x[0] == stratum and not x[2] and x[3]]
        most = rules.most_rejections(len(steps), 0.3, 0.05 / 3)
        safe = [s for s in range(1, 161) if sum(x is not None and x <= s for x in steps) <= most]
        assert got.get(stratum) == (max(safe) if safe else None)
    assert 0 in got and got[2] == 4


def test_rules_equal_their_sql(spark, tmp_path):
    import duckdb

    from grantlens.llm import registry

    rows = []
    for i in range(1500):
        text = prose(R.choice([30, 60, 200, 300]))
        rows.append((i if i % 50 else 7, text if i % 4 else text.replace(" ", R.choice(["*** ", "! ", " same words here "]), R.randint(1, 60)) + "\n\nx\nx"))
    rows += [(None, "a b c"), (9000, None), (9001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(1500)] + [(None, 1), (3, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = db.sql(registry.ORACLE_SQL["op7_quality_rules"]).fetchall()
    got = [tuple(x) for x in registry.QUERIES["op7_quality_rules"](spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter(want) and 50 < sum(not x[-1] and not x[-2] for x in got) < 600


def test_rules_use_no_python(spark):
    docs = spark.createDataFrame([(1, "a", "x")], DOCS)
    plan = rules.measures(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert rules.measures(docs).select(F.count("*")).first()[0] == 1
