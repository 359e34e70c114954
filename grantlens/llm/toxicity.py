"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small_table, table

#: Plain insults: a voter of its own, and what is left where labels are few.
INSULTS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
#: Labelled documents of either class, and as many without label, that terms are mined from and the linear classifier is
#: fitted on, first by hash of doc_id. The label model is fitted on the votes about all documents.
SAMPLE = 8000
#: Times that terms are mined.
MINED = 2
#: Lengths of stems, least documents that a stem is in, and the least part of the toxic ones.
STEMS, SUPPORT, SHARE = range(4, 11), 3, 1 / 400
#: Posteriors from which documents without label, and to which, terms are mined in the second round.
SURE = 0.95, 0.02
#: Share of a stem's weighted documents that are toxic, at least.
PRECISION = 0.88
#: A stem is there often if it opens so many words, and such a share of them.
OFTEN = 2, 0.004
#: Voters over mined terms.
GROUPS = 8
WORD_RE = re.compile(r"[^\W\d_]+")
PATTERNS = {
    "you_are": re.compile(r"\byou(?:'re| are| all are)\b|\bdu bist\b|\beres un|\btu es un", re.I),
    "masked": re.compile(r"\b[a-z][*@#$]{2,}[a-z]*\b", re.I),
    "shout": re.compile(r"!{3,}"),
    "hate": re.compile(r"\b(?:hate you|shut up|kill yourself)\b", re.I),
}


def stem_counts(text: str) -> tuple[Counter, int]:
    """How often each word of a text, and each of its beginnings, opens a word; and the words. Lower case."""
    words = Counter(WORD_RE.findall(text.lower()))
    out: Counter = Counter()
    for w, k in words.items():
        out[w] += k
        for n in STEMS:
            if len(w) <= n:
                break
            out[w[:n]] += k
    return out, word_number(text)


def word_number(text: str) -> int:
    return text.count(" ") + text.count("\n") + 1


def often(n: int, words: int) -> bool:
    return n >= OFTEN[0] and n >= OFTEN[1] * words


def mine_terms(sample: DataFrame, prior: float) -> list[tuple[str, int, float]]:
    """(stem, level, log odds) of beginnings of words that nearly only toxic documents have; sample: text, toxic.

    Level 1 is a stem that is there at all, level 2 one that is there often: stems that clean texts have now and
    then still tell. Documents are counted for each stem in Spark. What comes to the driver is bounded by the share of toxic
    documents that a stem is in: 400 times the stems of a document.
    """

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 250):
                seen: dict[tuple[str, int], list[int]] = {}
                for text, toxic in zip(b["text"][i : i + 250], b["toxic"][i : i + 250], strict=True):
                    stems, words = stem_counts(text)
                    for s, n in stems.items():
                        seen.setdefault((s, 1), [0, 0])[int(toxic)] += 1
                        if often(n, words):
                            seen.setdefault((s, 2), [0, 0])[int(toxic)] += 1
                yield pd.DataFrame(
                    {"stem": [s for s, _ in seen], "level": [v for _, v in seen], "clean": [x[0] for x in seen.values()], "toxic": [x[1] for x in seen.values()]}
                )

    sums = sample.mapInPandas(count, "stem string, level int, clean long, toxic long").groupBy("stem", "level").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    # documents weighted to the prior; half a clean document is added so that rare stems need more support
    a = (F.col("toxic") / n1) * prior
    b = ((F.col("clean") + 0.5) / n0) * (1 - prior)
    good = sums.where((F.col("toxic") >= max(SUPPORT, n1 * SHARE)) & (a / (a + b) >= PRECISION))
    top = good.select("stem", "level", F.log(a / b).alias("odds"))
    found = {(r.stem, r.level): float(r.odds) for r in top.collect()}
    # a longer stem, or the second level, adds nothing to a shorter one of the first
    less = lambda s, v: [(s[:n], u) for n in range(STEMS.start, len(s) + 1) for u in range(1, v + 1)]
    kept = [(s, v) for s, v in found if not any(x in found for x in less(s, v) if x != (s, v))]
    return sorted(((s, v, found[s, v]) for s, v in kept), key=lambda x: (-x[2], x[0]))


class Features:
    """Votes and counts of texts for a list of mined terms."""

    def __init__(self, terms: list[tuple[str, int, float]]):
        import ahocorasick

        self.names = ["insults", *[f"terms_{g}" for g in range(GROUPS)], *PATTERNS]
        self.groups = 1 + GROUPS
        # stem -> (level, voter); voters hold terms of like odds, so that their accuracies differ
        self.voters: dict[str, list[tuple[int, int]]] = {s: [(1, 0)] for s in INSULTS}
        for i, (s, level, _) in enumerate(terms):
            self.voters.setdefault(s, []).append((level, 1 + i * GROUPS // len(terms)))
        self.find = ahocorasick.Automaton()
        for s in self.voters:
            self.find.add_word(s, (len(s), s))
        self.find.make_automaton()

    def counts(self, text: str) -> tuple[np.ndarray, int, int]:
        """(hits of each voter, different terms that hit, words)."""
        low, words = text.lower(), word_number(text)
        hits: dict[str, int] = {}
        for end, (n, s) in self.find.iter(low):
            before = end - n
            if before < 0 or not low[before].isalpha():
                hits[s] = hits.get(s, 0) + 1
        out, kinds = np.zeros(len(self.names)), 0
        for s, n in hits.items():
            told = [voter for level, voter in self.voters[s] if level == 1 or often(n, words)]
            kinds += bool(told)
            for voter in told:
                out[voter] += n
        for i, p in enumerate(PATTERNS.values(), self.groups):
            out[i] = len(p.findall(text))
        return out, kinds, words

    def of(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """(votes 0/1, features) of texts."""
        got = [self.counts(t) for t in texts]
        hits = np.array([g[0] for g in got]).reshape(len(got), len(self.names))
        kinds = np.array([g[1] for g in got], dtype=float)
        words = np.array([g[2] for g in got], dtype=float)
        total = hits[:, : self.groups].sum(1)
        rate = 100 * total / np.maximum(words, 20)
        votes = np.column_stack([hits > 0, kinds >= 2, rate >= 1]).astype(float)
        features = np.column_stack(
            [np.log1p(hits), np.log1p(total), np.log1p(rate), np.log1p(100 * kinds / np.maximum(words, 20)), kinds >= 1, kinds >= 2, kinds >= 3]
        )
        return votes, features


class LabelModel:
    """A generative model of votes: a hidden class, voters that err at rates of their own, and correlated voters.

    Voters whose votes are correlated within the classes (beyond LINK), or nearly the same (DOUBLED), form one block,
    whose joint table of votes is estimated; blocks are independent given the class. People's labels are one more voter, of three votes (toxic,
    clean, none) and of no fixed accuracy: its table is estimated like the others. EM starts from the lexicon voters'
    opinion, takes all documents, labelled or not, and estimates tables and the class prior anew in each round.
    """

    LINK, DOUBLED, ROUNDS = 0.25, 0.8, 50

    def fit(self, votes: np.ndarray, labels: np.ndarray, prior: float, weight: np.ndarray) -> np.ndarray:
        """Posteriors of class 1; labels are 1, 0 or -1 for none; prior is where the estimate starts; weight counts documents."""
        # rare votes tell most; the share `prior` of documents that has most of them is taken as toxic to begin with
        told = votes @ -np.log(np.clip((votes * weight[:, None]).mean(0), 1e-6, 1))
        order = np.argsort(-told, kind="stable")
        most = np.cumsum(weight[order]) <= prior * weight.sum()
        post = np.full(len(votes), 0.1 * prior)
        post[order[most]] = np.where(told[order[most]] > 0, 0.9, 0.1 * prior)
        self.prior, self.blocks = prior, self.structure(votes, None, weight)
        post = self.estimate(votes, labels, weight, post)
        # which voters go together is seen once the classes are about right
        self.blocks = self.structure(votes, post, weight)
        return self.estimate(votes, labels, weight, post)

    def estimate(self, votes: np.ndarray, labels: np.ndarray, weight: np.ndarray, post: np.ndarray) -> np.ndarray:
        codes = [self.code(votes, b) for b in self.blocks] + [labels + 1]
        sizes = [1 << len(b) for b in self.blocks] + [3]
        for _ in range(self.ROUNDS):
            self.tables = []
            for code, size in zip(codes, sizes, strict=True):
                one = np.bincount(code, post * weight, size) + 0.5 / size
                none = np.bincount(code, (1 - post) * weight, size) + 0.5 / size
                self.tables.append(np.log(one / one.sum()) - np.log(none / none.sum()))
            self.prior = float(np.clip((post * weight).sum() / weight.sum(), 1e-4, 1 - 1e-4))
            odds = np.log(self.prior / (1 - self.prior)) + sum(t[c] for t, c in zip(self.tables, codes, strict=True))
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            done, post = np.abs(new - post).max() < 1e-4, new
            if done:
                break
        return post

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        codes = [self.code(votes, b) for b in self.blocks] + [labels + 1]
        odds = np.log(self.prior / (1 - self.prior)) + sum(t[c] for t, c in zip(self.tables, codes, strict=True))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def structure(self, votes: np.ndarray, post: np.ndarray | None, weight: np.ndarray) -> list[list[int]]:
        """Blocks of correlated voters; without posteriors, of nearly equal ones."""

        def correlations(p: np.ndarray) -> np.ndarray:
            mean = (votes * p[:, None]).sum(0) / p.sum()
            dev = (votes - mean) * np.sqrt(p / p.sum())[:, None]
            cov = dev.T @ dev
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-6))
            return np.abs(cov / np.outer(sd, sd))

        n = votes.shape[1]
        linked = (correlations(weight) > self.DOUBLED).astype(float)
        if post is not None:
            linked = np.maximum(linked, np.maximum(correlations(post * weight), correlations((1 - post) * weight)))
        blocks: list[list[int]] = []
        for v in range(n):
            near = [b for b in blocks if max(linked[v, u] for u in b) > self.LINK]
            if near:
                max(near, key=lambda b: max(linked[v, u] for u in b)).append(v)
            else:
                blocks.append([v])
        return blocks

    @staticmethod
    def code(votes: np.ndarray, block: list[int]) -> np.ndarray:
        return (votes[:, block].astype(int) << np.arange(len(block))).sum(1)


def fit_linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last coefficient is the constant."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    weight = weight / weight.sum()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - target)) + ridge * w
        hess = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model from docs (doc_id, text) and labels (doc_id, toxic).

    Terms are mined from at most `sample` labelled documents of each class; of rows of one doc_id one is. The label
    model is fitted on the votes about all documents, labelled or not, which are counted by their pattern; then terms
    are mined again with the documents, `sample` without label among them, that it is sure of, and it is fitted again.
    The linear classifier is fitted on the posteriors of the drawn documents.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = docs.select("doc_id").where("doc_id is not null").distinct().join(known, "doc_id", "left")
    ids = materialize(ids.withColumn("toxic", F.coalesce("toxic", F.lit(-1))), "tox-ids")
    sizes = {r.toxic: r["count"] for r in ids.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {"terms": [], "weights": None}
    prior = sizes[1] / (sizes[0] + sizes[1])
    order = F.xxhash64("doc_id", F.lit(5))
    pick = None
    for c in (-1, 0, 1):
        part = ids.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(sample)
        pick = part if pick is None else pick.unionByName(part)
    # at most 3 * sample rows are broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(pick), "doc_id")
    rows = materialize(rows.dropDuplicates(["doc_id"]), "tox-sample")

    def measured(terms: list[tuple[str, int, float]]) -> pd.DataFrame:
        def measure(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            features = Features(terms)
            for b in batches:
                votes, x = features.of(b["text"])
                yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "votes": list(votes), "x": list(x)})

        got = rows.mapInPandas(measure, "doc_id long, toxic int, votes array<double>, x array<double>").toPandas()
        return got.sort_values("doc_id", kind="stable")

    def patterns(terms: list[tuple[str, int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(votes, label, documents) of all documents by their pattern of votes: 2 ** voters times 3 rows at most."""

        def vote(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            features = Features(terms)
            for b in batches:
                votes, _ = features.of(b["text"])
                yield pd.DataFrame({"doc_id": b["doc_id"], "code": (votes.astype(np.int64) << np.arange(votes.shape[1])).sum(1)})

        told = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(vote, "doc_id long, code long")
        got = told.join(ids, "doc_id").groupBy("code", "toxic").count().toPandas().sort_values(["code", "toxic"])
        n = len(Features(terms).names) + 2
        return (got["code"].to_numpy()[:, None] >> np.arange(n) & 1).astype(float), got["toxic"].to_numpy(), got["count"].to_numpy(float)

    terms = mine_terms(rows.where("toxic >= 0"), prior)
    for round_ in range(MINED):
        model = LabelModel()
        all_votes, all_labels, documents = patterns(terms)
        model.fit(all_votes, all_labels, prior, documents)
        got = measured(terms)
        votes, x, toxic = np.array(got["votes"].tolist()), np.array(got["x"].tolist()), got["toxic"].to_numpy()
        post = model.posterior(votes, toxic)
        if round_ == MINED - 1:
            break
        sure = np.where(post >= SURE[0], 1, np.where(post <= SURE[1], 0, -1))
        sure = np.where(toxic >= 0, toxic, sure)
        known = {"doc_id": pa.array(got["doc_id"][sure >= 0], pa.int64()), "sure": pa.array(sure[sure >= 0], pa.int32())}
        told = F.broadcast(small_table(rows.sparkSession, known))
        terms = mine_terms(rows.join(told, "doc_id").select("text", F.col("sure").alias("toxic")), prior)
    # each kind of document weighs what it is in all
    weight = np.array([sizes.get(c, 0) / max(1, (toxic == c).sum()) for c in (-1, 0, 1)])[toxic + 1]
    return {"terms": terms, "weights": fit_linear(x, post, weight).tolist()}


def score(docs: DataFrame, model: dict, others: list[str | Column]) -> DataFrame:
    """docs' columns `others` and score (double), 0 to 1. Without a model (no labels) insults decide."""
    terms, weights = [tuple(t) for t in model["terms"]], model["weights"]
    if weights is None:
        size = len(INSULTS) and len(Features([]).of([""])[1][0]) + 1
        weights = [0.0] * size
        weights[0], weights[-1] = 4.0, -4.0
    spec = json.dumps({"terms": terms, "weights": weights})

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = json.loads(spec)
        features = Features([tuple(t) for t in known["terms"]])
        w = np.array(known["weights"])
        for texts in batches:
            _, x = features.of(texts)
            odds = x @ w[:-1] + w[-1] if len(x) else np.zeros(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -30, 30))))

    return docs.select(*others, judge(F.coalesce("text", F.lit(""))).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs' columns with score; labels (doc_id, toxic) teach it and are no input of a score.

    Null and empty texts are scored like a text without hits; repeated rows score alike; very long texts are scored
    whole; a column named score is replaced; without labels of both classes the built-in insults decide; empty in,
    empty out.
    """
    return score(docs, train(docs, labels, sample), [c for c in docs.columns if c != "score"])


def in_fold(modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod modulus = remainder; false for a null doc_id."""
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))
    return F.coalesce(rest == remainder, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents: doc_id, held_out, score, predicted (score >= 0.3)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~in_fold(4, 2))
    scored = score(docs, train(docs.where(~in_fold(4, 2)), labels), ["doc_id"])
    return scored.select(
        "doc_id", in_fold(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
