"""SimHash near-duplicates by anchor-point covering with perfect codes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, in_order, materialize, numbered, table, whole_row

#: Words of a shingle, seed of the hash, and differing bits of a link at most.
SHINGLE, SEED, THRESHOLD = 3, 42, 2
#: Perfect codes over the bits 0-22, 23-45, 46-60 and 61-63: (length, covering radius, generator polynomial). These are
#: the binary Golay code twice, a Hamming code and a code of two words. Every block is within the radius of one code
#: word exactly; 2**36 quadruples of code words are the anchors.
CODES = [(23, 3, 0xAE3), (23, 3, 0xAE3), (15, 1, 0x13), (3, 1, 0x7)]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of all shingles of a whole text (A-Z lower-cased); 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = [xxh64_intdigest(joined[s:e], SEED) for s, e in spans]
    ones = bit_counts(np.array(hashes, dtype=np.uint64))
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


@cache
def spread() -> np.ndarray:
    """For each byte eight bytes, each a bit of it."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits; byte lanes are added 255 at a time."""
    total = np.zeros(64, dtype=np.int64)
    table_ = spread()
    for i in range(0, len(hashes), 255 * 256):
        lanes = table_[hashes[i : i + 255 * 256].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        total += sums.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return total


def syndrome(words: np.ndarray, length: int, generator: int) -> np.ndarray:
    """Remainder of words of a block by the generator: equal for words that differ by a code word."""
    out, degree = np.zeros(words.shape, dtype=np.int64), generator.bit_length() - 1
    for bit in range(length):
        r = 1 << bit
        for k in range(bit, degree - 1, -1):
            if r >> k & 1:
                r ^= generator << (k - degree)
        out ^= np.where(words >> bit & 1, r, 0)
    return out


@cache
def coset_errors(length: int, radius: int, generator: int, flips: int) -> list[list[np.ndarray]]:
    """For each syndrome the bit patterns that lead to code words: within the radius, one bit beyond it, and so on."""
    size = 1 << (generator.bit_length() - 1)
    found: list[list[list[int]]] = [[[] for _ in range(flips + 1)] for _ in range(size)]
    for weight in range(radius + flips + 1):
        patterns = np.array([sum(1 << b for b in c) for c in combinations(range(length), weight)], dtype=np.int64)
        for s, p in zip(syndrome(patterns, length, generator).tolist(), patterns.tolist(), strict=True):
            found[s][max(0, weight - radius)].append(p)
    return [[np.array(x, dtype=np.int64) for x in row] for row in found]


def anchors(prints: np.ndarray, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into prints, anchor): all anchors within the covering radii plus `flips` bits, counted over the blocks.

    Of two fingerprints that differ by 2 * flips bits at most, each is within `flips` bits of one half way. The
    anchor nearest to that is one of both. So it is enough to go half the threshold beyond the radii from either side.
    """
    shift, total = 0, None
    for length, radius, generator in CODES:
        block = prints >> shift & ((1 << length) - 1)
        table_ = coset_errors(length, radius, generator, flips)
        of = syndrome(block, length, generator)
        index, code, used = [], [], []
        for s in np.unique(of):
            rows = np.flatnonzero(of == s)
            for over, patterns in enumerate(table_[s]):
                if len(patterns):
                    index.append(np.repeat(rows, len(patterns)))
                    code.append((block[rows][:, None] ^ patterns[None]).ravel() << shift)
                    used.append(np.full(len(rows) * len(patterns), over))
        index, code, used = np.concatenate(index), np.concatenate(code), np.concatenate(used)
        order = np.argsort(index, kind="stable")
        index, code, used = index[order], code[order], used[order]
        if total is None:
            total = index, code, used
        else:
            # each anchor so far with each code word of this block for the same fingerprint, as far as flips reach
            first = np.searchsorted(index, np.arange(len(prints) + 1))
            counts = np.diff(first)[total[0]]
            left = np.repeat(np.arange(len(total[0])), counts)
            right = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[total[0]], counts)
            good = total[2][left] + used[right] <= flips
            left, right = left[good], right[good]
            total = total[0][left], total[1][left] | code[right], total[2][left] + used[right]
        shift += length
    return total[0], total[1]


def with_fingerprints(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp long) of whole texts; a null text counts as empty."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prints = np.array([fingerprint(x, shingle) for x in b["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({key: b[key], "fp": prints})

    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"`{key}` long, fp long")


def at_anchors(prints: DataFrame, threshold: int) -> DataFrame:
    """(anchor, fp): values of prints (fp) at their anchors; such as differ by `threshold` bits (even) at most share one."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 4096):
                fp = b["fp"].to_numpy()[i : i + 4096]
                if len(fp):
                    index, anchor = anchors(fp, (threshold + 1) // 2)
                    yield pd.DataFrame({"anchor": anchor, "fp": fp[index]})

    return prints.select("fp").mapInPandas(run, "anchor long, fp long")


def close(a: str, b: str, threshold: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= threshold


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b), a < b, of different values of prints (fp) that differ by `threshold` bits (even) at most."""
    at = at_anchors(prints, threshold)
    left, right = at.withColumnRenamed("fp", "a"), at.withColumnRenamed("fp", "b")
    return left.join(right.hint("merge"), "anchor").where((F.col("a") < F.col("b")) & close("a", "b", threshold)).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, threshold: int = THRESHOLD, similarity: float | None = None) -> DataFrame:
    """docs (key, text) to (key, fp, component_id): documents linked through fingerprints within `threshold` bits.

    With `similarity`, a link of two fingerprints also needs that share of common shingles (Jaccard, of all different
    shingles of whole texts) between the first documents of both; equal fingerprints are taken as copies.

    Equal fingerprints are one node, so copies are never paired with each other. Texts without words have fingerprint
    0 and are linked like any other; repeated rows stay separate rows; a null key takes part but never names a
    component unless it is alone (then component_id is null); a very long text is hashed whole in one task; other
    columns are ignored; empty in, empty out.
    """
    found = materialize(with_fingerprints(docs, key, shingle), "fp")
    nodes = materialize(found.groupBy("fp").agg(F.min(key).alias("least")), "fp-nodes")
    dealt = nodes.repartition(nodes.sparkSession.sparkContext.defaultParallelism * 2, "fp")
    if similarity is None:
        parts = components(links(dealt, threshold))
    else:
        parts = confirmed_components(dealt, threshold, lambda edges: confirmed(edges, nodes, docs, key, shingle, similarity))
    grouped = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    of = grouped.join(least, "component").select("fp", "component_id")
    return found.join(of, "fp")


def confirmed_components(prints: DataFrame, threshold: int, confirm: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) by those links of prints (fp) within `threshold` bits that confirm keeps of a table (a, b).

    At each anchor the links of the least fingerprint come first. Of the others only those are asked for whose ends
    these have not joined yet, as the rest cannot change a component: so the many fingerprints of a large group of near
    copies are not paired with one another at each anchor that they share.
    """
    here = Window.partitionBy("anchor")
    at = at_anchors(prints, threshold).withColumns({"least": F.min("fp").over(here), "most": F.max("fp").over(here)})
    shared = materialize(at.where("least < most").drop("most"), "fp-anchors")
    stars = shared.where((F.col("least") < F.col("fp")) & close("least", "fp", threshold))
    first = components(confirm(stars.select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()))
    named = shared.select("anchor", "fp").join(first.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("anchor", "fp", F.coalesce("component", "fp").alias("of"))
    left, right = (named.select("anchor", F.col("fp").alias(x), F.col("of").alias(f"of_{x}")) for x in "ab")
    apart = (F.col("a") < F.col("b")) & (F.col("of_a") != F.col("of_b")) & close("a", "b", threshold)
    rest = left.join(right.hint("merge"), "anchor").where(apart).select("a", "b").distinct()
    return components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(confirm(rest)))


def shingles_of(text: str, shingle: int) -> set[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}


def confirmed(edges: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, shingle: int, similarity: float) -> DataFrame:
    """Those edges (a, b) of fingerprints whose first documents share enough shingles."""

    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right, strict=True):
            s, t = shingles_of(x or "", shingle), shingles_of(y or "", shingle)
            both = len(s & t)
            out.append(both >= similarity * (len(s) + len(t) - both))
        return pd.Series(out, dtype=bool)

    asked = materialize(edges, "fp-pairs")
    some = asked.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(nodes, "fp")
    texts = docs.select(F.col(key).cast("long").alias("least"), "text").join(some.hint("merge"), "least").select("fp", "text")
    left, right = texts.select(F.col("fp").alias("a"), F.col("text").alias("x")), texts.select(F.col("fp").alias("b"), F.col("text").alias("y"))
    both = asked.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return both.where(alike("x", "y")).select("a", "b")


def first_of_groups(docs: DataFrame, shingle: int = 5, threshold: int = 4, similarity: float = 0.8) -> DataFrame:
    """docs (doc_id, text, any more columns), one row of each group of near-duplicates: the first by doc_id.

    Rows are told apart by themselves and not by doc_id; of rows of one doc_id the first by the text's hash stays. Rows
    without doc_id come after all others. Columns, and their names, stay as they are.
    """
    rows = docs.select(whole_row(docs), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = numbered(in_order(rows, "doc_id").drop("doc_id"), "near")
    stay = near_duplicates(rows, "key", shingle, threshold, similarity).where("key = component_id").select("key")
    return rows.join(stay.hint("merge"), "key", "left_semi").select("row.*")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: doc_id, fingerprint, component_id."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
