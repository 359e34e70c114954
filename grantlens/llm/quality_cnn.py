"""Quality by a byte-level convolutional network in numpy."""

from __future__ import annotations

import base64
import pickle
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .toxicity import in_fold

#: Bytes of an embedding, width and step of the filters, filters, hidden units.
EMBED, WIDTH, STEP, FILTERS, HIDDEN = 4, 12, 4, 24, 12
#: Bytes of a chunk, and from one chunk to the next: chunks overlap by a filter's width and more.
CHUNK, STRIDE = 512, 448
#: Labelled documents of either class that the network is fitted on at most, first by hash of doc_id, whatever their
#: length; the bytes of their texts that the driver holds at once; and the chunks of a document that one step learns
#: from, drawn by chance anew for each step where there are more. Scores are of all chunks of all documents.
SAMPLE, HELD, LEARNED = 1500, 16 << 20, 256
#: Steps of the fit, the same at every size, documents of a step, and the first rate.
STEPS, BATCH, RATE = 1000, 32, 0.004
#: Chunks that are held at once.
SLICE = 256
#: Bytes back that a repeat is looked for.
LAGS = range(2, 41)


def byte_array(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)


def repeats(b: np.ndarray) -> np.ndarray:
    """1 where the five bytes that end here stand 2 to 40 bytes before, too."""
    out = np.zeros(len(b), dtype=bool)
    if len(b) > 6:
        w = b.astype(np.uint64)
        g = w[4:] | w[3:-1] << np.uint64(8) | w[2:-2] << np.uint64(16) | w[1:-3] << np.uint64(24) | w[:-4] << np.uint64(32)
        for lag in LAGS:
            if len(g) > lag:
                out[4 + lag :] |= g[lag:] == g[:-lag]
    return out.astype(np.float32)


def chunks_of(n: int) -> list[int]:
    """Where the overlapping chunks of n bytes begin; the last ends at or behind the end."""
    return list(range(0, max(1, n - (CHUNK - STRIDE)), STRIDE))


class Network:
    """Embedding -> filters -> ReLU -> maximum over a chunk -> mean and maximum over chunks -> hidden layer -> logit."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        channels = EMBED + 1  # the last channel marks repeats
        self.p = {
            "emb": r.normal(0, 0.5, (257, EMBED)).astype(np.float32),  # 256: behind the end
            "conv": (r.normal(0, 1, (WIDTH * channels, FILTERS)) / np.sqrt(WIDTH * channels)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "w1": (r.normal(0, 1, (2 * FILTERS, HIDDEN)) / np.sqrt(2 * FILTERS)).astype(np.float32),
            "b1": np.zeros(HIDDEN, np.float32),
            "w2": (r.normal(0, 1, HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32),
            "b2": np.zeros(1, np.float32),
        }

    def windows(self, codes: np.ndarray, copy: np.ndarray) -> np.ndarray:
        """(chunks, positions, width * channels) of codes (chunks, CHUNK)."""
        x = np.concatenate([self.p["emb"][codes], copy[..., None]], axis=-1)
        x = x.reshape(len(codes), -1)
        c = EMBED + 1
        view = np.lib.stride_tricks.sliding_window_view(x, WIDTH * c, axis=1)[:, :: STEP * c]
        return np.ascontiguousarray(view)

    def pooled(self, codes: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features of chunks, positions of the maxima, windows)."""
        w = self.windows(codes, copy)
        z = (w.reshape(-1, w.shape[-1]) @ self.p["conv"]).reshape(*w.shape[:2], -1)
        at = z.argmax(1)
        top = np.take_along_axis(z, at[:, None], 1)[:, 0] + self.p["bias"]
        return np.maximum(top, 0), at, w

    def fast(self, codes: np.ndarray, copy: np.ndarray) -> np.ndarray:
        """Features of chunks, for scoring."""
        w = self.windows(codes, copy)
        z = (w.reshape(-1, w.shape[-1]) @ self.p["conv"]).reshape(*w.shape[:2], -1)
        return np.maximum(z.max(1) + self.p["bias"], 0)

    def head(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(features @ self.p["w1"] + self.p["b1"], 0)
        return h @ self.p["w2"] + self.p["b2"], h

    def fit(self, drawn: Iterator[tuple[Iterable, float, float]], batch: int = BATCH) -> None:
        """drawn: (slices of chunks, label, weight) of one document after another, without end. Adam on the weighted log loss."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            docs, y, weight = zip(*islice(drawn, batch), strict=True)
            rate = RATE * (1 - step / STEPS) + 1e-4
            for k, g in self.gradients(docs, np.array(y, np.float32), np.array(weight, np.float32)).items():
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.001 * (g * g - s[k])
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)

    def gradients(self, docs: Iterable[Iterable], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """docs: of each document slices (codes, repeats) of chunks, which are gone through twice.

        Of a chunk only the maxima and their places are kept from the first time to the second, so that long documents
        need little memory.
        """
        sizes = np.zeros(len(y), np.int64)
        maxima, places = [], []
        for codes, copy in gathered(docs, sizes):
            f, at, _ = self.pooled(codes, copy.astype(self.p["conv"].dtype))
            maxima.append(f)
            places.append(at.astype(np.int16))
        f, at = np.concatenate(maxima), np.concatenate(places).astype(np.int64)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        of = np.repeat(np.arange(len(y)), sizes)
        mean, top = np.add.reduceat(f, starts) / sizes[:, None], np.maximum.reduceat(f, starts)
        features = np.concatenate([mean, top], axis=1)
        logit, h = self.head(features)
        dz = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / len(y)
        g = {"w2": h.T @ dz, "b2": dz.sum(keepdims=True)}
        dh = dz[:, None] * self.p["w2"] * (h > 0)
        g["w1"], g["b1"] = features.T @ dh, dh.sum(0)
        df = dh @ self.p["w1"].T
        # of equal maxima the first takes the gradient
        best = f == top[of]
        seen = np.cumsum(best, axis=0)
        first = best & (seen - (seen[starts] - best[starts])[of] == 1)
        dtop = ((df[:, :FILTERS] / sizes[:, None])[of] + df[:, FILTERS:][of] * first) * (f > 0)
        g["bias"] = dtop.sum(0)
        g["conv"], g["emb"] = np.zeros_like(self.p["conv"]), np.zeros((257, EMBED))
        begin = 0
        for codes, copy in gathered(docs, sizes):
            d, place = dtop[begin : begin + len(codes)], at[begin : begin + len(codes), :, None] * STEP + np.arange(WIDTH)
            begin += len(codes)
            row = np.arange(len(codes))[:, None, None]
            code = codes[row, place]
            windows = np.concatenate([self.p["emb"][code], copy[row, place][..., None]], axis=-1).reshape(len(codes), FILTERS, -1)
            g["conv"] += np.einsum("bf,bfk->kf", d, windows, optimize=True)
            back = (d[:, :, None] * self.p["conv"].T[None]).reshape(len(codes), FILTERS, WIDTH, EMBED + 1)
            for e in range(EMBED):
                g["emb"][:, e] += np.bincount(code.ravel(), back[..., e].ravel(), 257)
        return {k: v.astype(np.float32) for k, v in g.items()}


def gathered(docs: Iterable[Iterable], sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of all docs one after another, short ones put together; sizes gets each document's chunks."""
    codes: list[np.ndarray] = []
    copies: list[np.ndarray] = []
    for i, doc in enumerate(docs):
        sizes[i] = 0
        for c, k in doc:
            sizes[i] += len(c)
            codes.append(c)
            copies.append(k)
            if sum(map(len, codes)) >= SLICE:
                yield np.concatenate(codes), np.concatenate(copies)
                codes, copies = [], []
    if codes:
        yield np.concatenate(codes), np.concatenate(copies)


def slices(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, repeats) of SLICE chunks of a whole text at a time; 256 stands behind the end."""
    return sliced(byte_array(text))


class Drawn:
    """A text to learn from, as bytes and bits of repeats: chunks, all or those of `picked` numbers, each time it is gone through."""

    def __init__(self, text: bytes, marks: bytes, picked: np.ndarray | None = None):
        self.text, self.marks, self.picked = text, marks, picked

    def once(self, r: np.random.Generator) -> Drawn:
        """The text with the chunks of one step."""
        n = len(chunks_of(len(self.text)))
        return Drawn(self.text, self.marks, np.sort(r.choice(n, LEARNED, replace=False))) if n > LEARNED else self

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        b = np.frombuffer(self.text, np.uint8)
        marks = np.unpackbits(np.frombuffer(self.marks, np.uint8), count=len(b))
        if self.picked is None:
            yield from sliced(b, marks)
            return
        place = self.picked[:, None] * STRIDE + np.arange(CHUNK)
        inside = place < len(b)
        place = np.minimum(place, len(b) - 1)
        yield np.where(inside, b[place], 256).astype(np.int16), np.where(inside, marks[place], 0).astype(np.float32)


def sliced(b: np.ndarray, marks: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same of bytes; marks: their repeats, if they are known."""
    starts = np.array(chunks_of(len(b)))
    for i in range(0, len(starts), SLICE):
        own = starts[i : i + SLICE]
        begin, end = own[0], own[-1] + CHUNK
        codes = np.full(end - begin, 256, dtype=np.int16)
        codes[: max(0, len(b) - begin)] = b[begin:end]
        copy = np.zeros(end - begin, np.float32)
        if marks is None:
            # a repeat looks back over the start of the slice
            before = max(0, begin - LAGS[-1] - 5)
            copy[: max(0, len(b) - begin)] = repeats(b[before:end])[begin - before :]
        else:
            copy[: max(0, len(b) - begin)] = marks[begin:end]
        index = (own - begin)[:, None] + np.arange(CHUNK)
        yield codes[index], copy[index]


def cut_chunks(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, repeats) of all chunks of a whole text."""
    codes, copies = zip(*slices(text), strict=True)
    return np.concatenate(codes), np.concatenate(copies)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the documents that have a label, each once."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    return materialize(known.join(docs.select("doc_id").distinct(), "doc_id"), "quality-ids")


def drawn_texts(docs: DataFrame, known: DataFrame, sample: int) -> DataFrame:
    """(quality, text, marks) of at most `sample` documents of either class of known, text and repeats as bytes; one row of each doc_id."""
    order = [F.xxhash64("doc_id", F.lit(6)), F.col("doc_id")]
    part = [known.where(F.col("quality") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    # at most 2 * sample rows are broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(part[0].unionByName(part[1])), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            b = [byte_array(x) for x in p["text"]]
            yield pd.DataFrame({"doc_id": p["doc_id"], "quality": p["quality"], "text": [x.tobytes() for x in b], "marks": [np.packbits(repeats(x) > 0).tobytes() for x in b]})

    once = materialize(rows.dropDuplicates(["doc_id"]).mapInPandas(run, "doc_id long, quality int, text binary, marks binary"), "quality-texts")
    size = once.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # by hash, and few bytes at a time go to the driver
    return materialize(once.repartition(int(1 + size // HELD), F.xxhash64("doc_id", F.lit(7))).drop("doc_id"), "quality-drawn")


def without_end(drawn: DataFrame, weights: tuple[float, float], seed: int = 2) -> Iterator[tuple[Drawn, float, float]]:
    """(text, label, weight) of all rows of drawn over and over, in an order by chance within HELD bytes of them.

    Where all texts have no more bytes than that, they are read once; else they come from the shared folder each time.
    """
    r = np.random.default_rng(seed)

    def mixed(rows: list[tuple[Drawn, float, float]]) -> Iterator[tuple[Drawn, float, float]]:
        for i in r.permutation(len(rows)):
            text, label, weight = rows[i]
            yield text.once(r), label, weight

    while True:
        held: list[tuple[Drawn, float, float]] = []
        size, parts = 0, 0
        for x in drawn.toLocalIterator():
            held.append((Drawn(bytes(x["text"]), bytes(x["marks"])), float(x["quality"]), weights[x["quality"]]))
            size += len(x["text"])
            if size > HELD:
                yield from mixed(held)
                held, size, parts = [], 0, parts + 1
        yield from mixed(held)
        while not parts:
            yield from mixed(held)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> str | None:
    """The fitted network from docs (doc_id, text) and labels (doc_id, quality); None without labels of both classes.

    It is fitted on the driver, on texts of at most `sample` documents of a class, of any length, which pass some 16 MB
    at a time; of a text of over LEARNED chunks each step takes so many by chance. Of rows of one doc_id one is drawn.
    """
    known = labelled(docs, labels)
    sizes = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return None
    drawn = drawn_texts(docs, known, sample)
    prior, share = sizes[1] / (sizes[0] + sizes[1]), min(sizes[1], sample) / (min(sizes[0], sample) + min(sizes[1], sample))
    # half way between the labels' shares and even classes
    aim = (prior + 0.5) / 2
    net = Network()
    net.fit(without_end(drawn, ((1 - aim) / (1 - share), aim / share)), min(BATCH, sizes[0] + sizes[1]))
    return base64.b64encode(pickle.dumps(net.p)).decode()


def score(docs: DataFrame, model: str | None, others: list[str | Column]) -> DataFrame:
    """docs' columns `others` and score: the probability of quality 1 of each whole text; 0.5 without a model."""
    if model is None:
        return docs.select(*others, F.lit(0.5).alias("score"))

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = Network()
        net.p = pickle.loads(base64.b64decode(model))
        for texts in batches:
            out: list[float] = []
            codes: list[np.ndarray] = []
            copies: list[np.ndarray] = []

            def judged(mean: np.ndarray, top: np.ndarray) -> None:
                logit, _ = net.head(np.concatenate([mean, top], axis=1))
                out.extend(1 / (1 + np.exp(-np.clip(logit.astype(float), -30, 30))))

            def flush() -> None:
                if not codes:
                    return
                sizes = np.array([len(c) for c in codes])
                f = net.fast(np.concatenate(codes), np.concatenate(copies))
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                judged(np.add.reduceat(f, starts) / sizes[:, None], np.maximum.reduceat(f, starts))
                codes.clear()
                copies.clear()

            for text in texts:
                if len(text) < 64 * STRIDE:
                    # several short documents at a time
                    c, k = cut_chunks(text)
                    codes.append(c)
                    copies.append(k)
                    if sum(map(len, codes)) >= SLICE:
                        flush()
                    continue
                # a long one is read in slices
                flush()
                total, top, n = np.zeros((1, FILTERS)), np.zeros((1, FILTERS)), 0
                for c, k in slices(text):
                    f = net.fast(c, k)
                    total, top, n = total + f.sum(0), np.maximum(top, f.max(0)), n + len(f)
                judged((total / n).astype(np.float32), top.astype(np.float32))
            flush()
            yield pd.Series(out, dtype=float)

    return docs.select(*others, judge(F.coalesce("text", F.lit(""))).alias("score"))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs' columns with score; labels (doc_id, quality) teach it and are no input of a score.

    Null and empty texts are scored as one chunk without bytes; repeated rows score alike; very long texts are scored
    whole, 256 chunks at a time; a column named score is replaced; without labels of both classes every score is 0.5; empty in, empty out.
    """
    return score(docs, train(docs, labels, sample), [c for c in docs.columns if c != "score"])


def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents: doc_id, held_out, score, predicted (score >= 0.5)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~in_fold(3, 1))
    scored = score(docs, train(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", in_fold(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
