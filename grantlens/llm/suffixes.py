"""Repeated bytes by suffix order: longest previous factors, of which later copies are removed and the first is kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, in_order, materialize, numbered, table, with_end

#: Bytes of a string that is removed where it comes again.
LENGTH = 100
#: Bytes of an anchor: each string of LENGTH bytes is filed under its anchor of the least hash, the leftmost of several.
ANCHOR = 40
#: Strings (starts) of a text that are hashed at once.
SLICE = 1 << 19
#: Different stretches that share an anchor, and are put in suffix order in one task. Anchors of more go by digests.
STRETCHES = 2000
#: An anchor is dealt out to many tasks if it has this share of a sample's anchors; so there are HOT of them at most.
HOT, HOT_SAMPLE = 4096, 20_000

R = np.random.default_rng(11)
BYTE_CODES = R.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def rolled(codes: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of all runs of n codes, by doubling."""
    out, have = None, 0
    h, width, power = codes, 1, base
    while True:
        if n & 1:
            m = len(codes) - have - width + 1
            out, have = h if out is None else out[:m] * power + h[have : have + m], have + width
        n >>= 1
        if not n:
            return out
        h = h[:-width] * power + h[width:]
        width, power = width * 2, np.uint64(int(power) ** 2 % 2**64)


def least(values: np.ndarray, n: int) -> np.ndarray:
    """The minimum of each n values in a row."""
    width = 1
    while 2 * width <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (n - width)], values[n - width :]) if n > width else values


def stretches(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, digest, start, n): n strings of `length` bytes from start on in a row that have the same anchor.

    Which anchor a string has, and its hash (key), depend on the string alone: equal strings, wherever they are, are
    filed under equal keys. digest is of all bytes of the stretch's strings, start to start + n + length - 1.
    """
    b = np.frombuffer(text, np.uint8)
    for at in range(0, len(b) - length + 1, SLICE):
        part = b[at : at + SLICE + length - 1]
        codes = BYTE_CODES[0][part]
        h = mixed(rolled(codes, anchor, BASES[0]))
        # of equal hashes the leftmost: the place stands below 44 bits of hash
        places = h >> np.uint64(20) << np.uint64(20) | np.arange(len(h), dtype=np.uint64)
        own = (least(places, length - anchor + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        n = np.diff(np.r_[start, len(own)])
        yield h[own[start]].view(np.int64), digests(part, start, n + length - 1), start + at, n


def digests(part: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit digests of part[start : start + size], from sums of codes times powers."""
    powers = power_table(len(part) + 1)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(BYTE_CODES[1][part] * powers[0][: len(part)], out=sums[1:])
    whole = (sums[start + size] - sums[start]) * powers[1][start]
    return mixed(whole + size.astype(np.uint64) * BASES[0]).view(np.int64)


POWERS: list[np.ndarray] = []


def power_table(n: int) -> list[np.ndarray]:
    """Powers of the second base and of its inverse, modulo 2**64."""
    if not POWERS or len(POWERS[0]) < n:
        n = max(n, 1 << 16)
        base = int(BASES[1])
        POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (base, pow(base, -1, 1 << 64))]
    return POWERS


def longest_previous(suffixes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """LPF: for each suffix the bytes it shares with a suffix that starts earlier, most of all such.

    suffixes: (n, length) bytes, as much of each suffix as counts; starts: where they start, n different numbers. In
    suffix order (ties by start) the longest match with an earlier start is with the nearest suffix on either side that
    starts earlier, and the shared length is the least of the lengths that neighbours between share.
    """
    n, length = suffixes.shape
    rows = np.ascontiguousarray(suffixes).view(f"S{length}").ravel()
    order = np.lexsort((starts, rows))
    in_order = suffixes[order]
    same = in_order[1:] == in_order[:-1]
    shared = np.where(same.all(1), length, (~same).argmax(1))
    # a place's own entry is what it shares with the one before
    lcp = np.r_[0, shared].tolist()
    at = starts[order].tolist()
    found = [0] * n
    stack: list[tuple[int, int]] = []  # (start, least shared from the one below on), starts ascending
    for rank in range(n):
        low = lcp[rank]
        while stack and stack[-1][0] > at[rank]:
            _, between = stack.pop()
            low = min(low, between)
        found[rank] = low if stack else 0
        stack.append((at[rank], low))
    stack = []
    for rank in range(n - 1, -1, -1):
        low = lcp[rank + 1] if rank + 1 < n else 0
        while stack and stack[-1][0] > at[rank]:
            _, between = stack.pop()
            low = min(low, between)
        if stack and low > found[rank]:
            found[rank] = low
        stack.append((at[rank], low))
    out = np.empty(n, np.int64)
    out[order] = found
    return out


def common_anchors(docs: DataFrame, rows: int) -> np.ndarray:
    """Keys that a sample of documents has most: their rows are dealt out to many tasks. There are HOT at most.

    They steer where rows go, and not what is found.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [x[0] for text in b["text"] for x in stretches(bytes(text))]
            if found:
                yield pd.DataFrame({"key": np.concatenate(found)})

    step = max(1, rows // HOT_SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).select("text").mapInPandas(run, "key long")
    counts = materialize(sample.groupBy("key").count(), "anchors")
    total = counts.agg(F.sum("count")).first()[0] or 0
    most = counts.where(F.col("count") > F.lit(max(8, total // HOT))).select("key").toPandas()
    return np.sort(most["key"].to_numpy(np.int64))


PLACES = "key long, digest long, salt int, pos long, n int"


def placed(docs: DataFrame, bits: int, common: np.ndarray) -> DataFrame:
    """PLACES of all stretches of docs (key, text as bytes): pos is document << bits | start; salt is over 0 for common keys."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts: list[tuple] = []
            size = 0
            for doc, text in zip(b["key"].tolist(), b["text"], strict=True):
                for key, digest, start, n in stretches(bytes(text)):
                    salt = np.zeros(len(key), np.int32)
                    if len(common):
                        salt[common[np.minimum(np.searchsorted(common, key), len(common) - 1)] == key] = 1 + doc % 4093
                    parts.append((key, digest, salt, (doc << bits) + start, n.astype(np.int32)))
                    size += len(key)
                if size > 1 << 17:
                    yield joined(parts)
                    parts, size = [], 0
            if parts:
                yield joined(parts)

    def joined(parts: list[tuple]) -> pd.DataFrame:
        columns = ["key", "digest", "salt", "pos", "n"]
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(columns, zip(*parts, strict=True), strict=True)})

    return docs.select("key", "text").mapInPandas(run, PLACES)


#: Kinds of rows: all strings of the stretch start earlier, too; first of its kind, to be compared; the same, of a common key.
REMOVED, COMPARE, COMMON = 0, 1, 2


def met(places: DataFrame, whole: bool) -> DataFrame:
    """(kind, key, digest, pos, n): what follows from stretches of one key and digest, which are equal in all bytes.

    All but the first of equal stretches are REMOVED. The first is to be compared with others of its key, if there are
    any (`whole`: all of a key meet here), else it is of no more use. Rows in order of key, digest, place go by; no
    group is held. Rows of common keys meet in groups by salt, and the firsts of these once more.
    """
    columns = ["kind", "key", "digest", "pos", "n"]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the last row's key, digest and salt; the key's first stretch while it is the only one
        last: tuple | None = None
        alone: tuple | None = None
        for b in batches:
            if not len(b):
                continue
            key, digest, salt, pos, n = (b[c].to_numpy() for c in ("key", "digest", "salt", "pos", "n"))
            new_key = np.r_[last is None or last[0] != key[0] or last[2] != salt[0], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])]
            new = new_key | np.r_[last is None or last[1] != digest[0], digest[1:] != digest[:-1]]
            out = [(np.full((~new).sum(), REMOVED, np.int8), key[~new], digest[~new], pos[~new], n[~new])]
            first = np.flatnonzero(new)
            if len(first):
                if not whole:
                    out.append((np.full(len(first), COMPARE, np.int8), key[first], digest[first], pos[first], n[first]))
                else:
                    opens = new_key[first]
                    # a first stretch is compared if another follows in its key, or it is not the key's first
                    followed = np.r_[~opens[1:], False]
                    kind = np.where(salt[first] > 0, COMMON, COMPARE).astype(np.int8)
                    use = ~opens | followed | (kind == COMMON)
                    out.append((kind[use], key[first][use], digest[first][use], pos[first][use], n[first][use]))
                    if alone is not None and not opens[0]:
                        out.append(tuple(np.array([x]) for x in alone))
                    end = first[-1]
                    if not use[-1]:
                        alone = (np.int8(COMPARE), key[end], digest[end], pos[end], n[end])
                    else:
                        alone = None
            last = (key[-1], digest[-1], salt[-1])
            yield pd.DataFrame({c: np.concatenate(x) for c, x in zip(columns, zip(*out, strict=True), strict=True)})

    group = ["key", "salt"] if whole else ["key", "digest"]
    dealt = places.repartition(*group).sortWithinPartitions("key", "salt", "digest", "pos")
    return dealt.mapInPandas(run, "kind byte, key long, digest long, pos long, n int")


def contents(docs: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """wanted (key, pos, n, many) with `bytes`, the bytes of each stretch's strings, from docs (key, text)."""
    mask = (1 << bits) - 1

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            size = 0
            for doc, text, spans in zip(b["doc"], b["text"], b["spans"], strict=True):
                for x in spans:
                    start = x["pos"] & mask
                    out.append((x["key"], x["pos"], x["n"], x["many"], bytes(text[start : start + x["n"] + LENGTH - 1])))
                    size += x["n"] + LENGTH
                    if size > 4 << 20:
                        yield pd.DataFrame(out, columns=["key", "pos", "n", "many", "bytes"])
                        out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=["key", "pos", "n", "many", "bytes"])

    # a document's list is no longer than the document
    lists = wanted.groupBy(F.shiftright("pos", bits).alias("doc")).agg(F.collect_list(F.struct("key", "pos", "n", "many")).alias("spans"))
    texts = docs.select(F.col("key").alias("doc"), "text").join(lists.hint("merge"), "doc")
    return texts.mapInPandas(run, "key long, pos long, n int, many boolean, bytes binary")


def windows(size: np.ndarray, data: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strings as rows of LENGTH bytes, stretch of each, its place in the stretch) of stretches that follow each other in data."""
    begin = np.r_[0, np.cumsum(size)[:-1]]
    of = np.repeat(np.arange(len(n)), n)
    inside = np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
    view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    return view[begin[of] + inside], of, inside


def runs(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places as runs of neighbours (first, how many)."""
    first = np.flatnonzero(np.r_[True, np.diff(pos) != 1])
    return pos[first], np.diff(np.r_[first, len(pos)])


def later_in_suffix_order(cut: DataFrame) -> DataFrame:
    """(pos, n) runs of strings that start earlier, too, of stretches (key, pos, n, bytes): LPF of LENGTH at least.

    Equal strings have one key, so that each key's strings are put in suffix order by themselves, many keys at a time.
    """

    def compared(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        size = b["bytes"].map(len).to_numpy(np.int64)
        data = np.frombuffer(b"".join(b["bytes"]), np.uint8)
        n = b["n"].to_numpy(np.int64)
        if not len(n):
            return
        strings, of, inside = windows(size, data, n)
        starts = b["pos"].to_numpy()[of] + inside
        # only a string whose digest comes again can be an earlier or a later copy
        code = rolled(BYTE_CODES[1][data], LENGTH, BASES[1])[np.r_[0, np.cumsum(size)[:-1]][of] + inside]
        order = np.argsort(code, kind="stable")
        twice = np.r_[False, code[order][1:] == code[order][:-1]]
        twice |= np.r_[twice[1:], False]
        some = order[twice]
        if not len(some):
            return
        found = longest_previous(strings[some], starts[some])
        later = np.sort(starts[some][found >= LENGTH])
        if len(later):
            first, many = runs(later)
            yield pd.DataFrame({"pos": first, "n": many.astype(np.int32)})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for b in with_end(batches):
            if b is None:
                if held:
                    yield from compared(pd.concat(held, ignore_index=True))
                return
            if not len(b):
                continue
            key = b["key"].to_numpy()
            end = len(b) - int(np.argmax(key[::-1] != key[-1])) if (key != key[-1]).any() else 0
            if end and (rows + end >= STRETCHES or held and held[-1]["key"].iloc[-1] != key[0]):
                yield from compared(pd.concat([*held, b[:end]], ignore_index=True))
                held, rows, b = [], 0, b[end:]
            held.append(b)
            rows += len(b)

    dealt = cut.select("key", "pos", "n", "bytes").repartition("key").sortWithinPartitions("key", "pos")
    return dealt.mapInPandas(run, "pos long, n int")


def later_by_digest(cut: DataFrame) -> DataFrame:
    """The same for stretches of keys that very many share: strings meet by 128 bits of digests, whose first is kept."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 500):
                p = b[i : i + 500]
                size, n = p["bytes"].map(len).to_numpy(np.int64), p["n"].to_numpy(np.int64)
                data = np.frombuffer(b"".join(p["bytes"]), np.uint8)
                at = np.repeat(np.r_[0, np.cumsum(size)[:-1]], n)
                inside = np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
                two = [mixed(rolled(BYTE_CODES[k][data], LENGTH, BASES[k])[at + inside]).view(np.int64) for k in (0, 1)]
                yield pd.DataFrame({"key": two[0], "digest": two[1], "pos": np.repeat(p["pos"].to_numpy(), n) + inside})

    strings = cut.select("pos", "n", "bytes").mapInPandas(run, "key long, digest long, pos long")
    # first within salts, then the firsts of these: no digest's rows meet in one task
    strings = strings.select("key", "digest", (F.pmod(F.xxhash64("pos"), F.lit(4093)) + 1).cast("int").alias("salt"), "pos", F.lit(1).alias("n"))
    once = materialize(met(strings, True), "strings")
    firsts = once.where(F.col("kind") == COMMON).select("key", "digest", F.lit(0).alias("salt"), "pos", "n")
    twice = met(firsts, False)
    return once.unionByName(twice).where(F.col("kind") == REMOVED).select("pos", "n")


def removed_runs(docs: DataFrame) -> DataFrame:
    """(doc, spans): of docs (key from 0 on, text as bytes) the runs (start, n) of strings of LENGTH that start earlier, too."""
    size = docs.agg(F.max("key"), F.max(F.octet_length("text"))).first()
    bits = max(8, int(size[1] or 0).bit_length())
    if (size[0] or 0).bit_length() + bits > 62:
        raise ValueError("too many documents for texts of this length")
    common = common_anchors(docs, (size[0] or 0) + 1)
    once = materialize(met(placed(docs, bits, common), True), "met")
    firsts = once.where(F.col("kind") == COMMON).select("key", "digest", F.lit(0).alias("salt"), "pos", "n")
    twice = materialize(met(firsts, False), "met")
    compare = once.where(F.col("kind") == COMPARE).unionByName(twice.where(F.col("kind") == COMPARE))
    # how many stretches a key has says how they are compared; keys of many are few, but no bound on them is known
    many = compare.groupBy("key").count().where(F.col("count") > STRETCHES).select("key", F.lit(True).alias("many"))
    asked = compare.select("key", "pos", "n").join(many.hint("merge"), "key", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    cut = materialize(contents(docs, asked, bits), "stretches")
    found = [x.where(F.col("kind") == REMOVED).select("pos", "n") for x in (once, twice)]
    found += [later_in_suffix_order(cut.where("not many")), later_by_digest(cut.where("many"))]
    whole = found[0]
    for x in found[1:]:
        whole = whole.unionByName(x)
    spans = whole.groupBy(F.shiftright("pos", bits).alias("doc")).agg(
        F.collect_list(F.struct(F.col("pos").bitwiseAND(F.lit((1 << bits) - 1)).alias("start"), "n")).alias("spans")
    )
    out = materialize(spans, "spans")
    for x in (once, twice, cut):
        forget(x)
    return out


def merged(spans: Iterable, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of bytes that spans' strings cover."""
    out: list[list[int]] = []
    for start, n in sorted((x["start"], x["n"]) for x in spans):
        end = min(n_bytes, start + n + LENGTH - 1)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def in_bytes(documents: DataFrame) -> DataFrame:
    """Rows (key, doc_id, text as UTF-8) in order of doc_id: nulls last, rows of one id by their texts' hash."""
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return numbered(in_order(ids, "doc_id").withColumn("text", F.col("text").cast("binary")), "suffixes")


def marked(rows: DataFrame) -> DataFrame:
    """rows (as of in_bytes) with spans: their removed strings, or null."""
    spans = removed_runs(rows).withColumnRenamed("doc", "key")
    return rows.join(spans.hint("merge"), "key", "left")


RESULT = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_report(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of documents (doc_id, text).

    A byte is removed if a string of LENGTH bytes that covers it also starts earlier: in a row before, or before in the
    same row. Rows are in order of doc_id; rows of one id are documents each, in order of their texts' hash, and rows
    without id come last. Null texts are empty, texts under LENGTH bytes lose nothing, very long ones are hashed in
    slices and held by one task, whole. Other columns are ignored; empty in, empty out.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, text, spans in zip(b["doc_id"], b["text"], b["spans"], strict=True):
                text = memoryview(text)
                cut = [] if spans is None else merged(spans, len(text))
                kept, at = hashlib.sha256(), 0
                for s, e in cut:
                    kept.update(text[at:s])
                    at = e
                kept.update(text[at:])
                out.append((name, len(text), sum(e - s for s, e in cut), len(cut), kept.hexdigest()))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in RESULT.split(", ")])

    rows = marked(in_bytes(documents)).select(F.col("doc_id").cast("string").alias("doc_id"), "text", "spans")
    done = rows.mapInPandas(run, RESULT)
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that repeat 100 bytes from before: how many go, in how many runs, and the hash of the rest."""
    return suffix_report(table(spark, sf_dir, "documents"))
