"""Source divergence audit: how the sources of a language differ in their terms, with strings joined back last."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, materialize, table

#: Documents of a language that a kept term is in at least, and ranks of the part `term`.
MIN_DOCS, RANKS = 10, 10
#: Bits of a term's digest; tests make them few, so that terms collide.
BITS = 64
#: log2 of the bits of the table that tells which digests may be kept: 8 MB, whatever the input.
FILTER = 26
#: Terms, of all groups, that a task holds before it passes them on.
HELD = 1 << 22
#: Groups (lang, source) that are broadcast at most; more are joined by a shuffle.
FEW_GROUPS = 20_000
#: Bytes that end a term become spaces, A-Z small letters; all bytes from 128 on belong to terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


#: Odd numbers for the bytes of a term, and the bases of their places, for two independent hashes.
CODES = np.random.default_rng(17).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Bytes that are hashed at once.
PIECE = 1 << 20


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters A-Z, a-z and of all characters beyond ASCII, A-Z as small letters, in UTF-8."""
    return text.translate(LETTERS).split()


class Terms:
    """Terms of bytes: where they start and end, and their hashes."""

    def __init__(self, data: bytes):
        self.data = data.translate(LETTERS)
        self.bytes = np.frombuffer(self.data, np.uint8)
        inside = np.r_[False, self.bytes != 32, False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each term: sums of its bytes' numbers times powers of a base, mixed."""
        size = self.end - self.start
        out = np.zeros(len(size), np.uint64)
        # pieces end where terms end
        cuts = np.searchsorted(self.end, np.arange(0, len(self.bytes), PIECE), side="left")
        cuts = np.unique(np.r_[cuts, len(size)])
        if len(size) and len(POWERS[which]) < size.max():
            POWERS[which] = np.cumprod(np.r_[np.uint64(1), np.full(max(255, int(size.max())), BASES[which], np.uint64)])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            n, a, e = size[lo:hi], self.start[lo], self.end[hi - 1]
            b = self.bytes[a:e]
            b = b[b != 32]
            first = np.r_[0, np.cumsum(n)[:-1]]
            place = np.arange(len(b)) - np.repeat(first, n)
            out[lo:hi] = np.add.reduceat(CODES[which][b] * POWERS[which][place], first)
        out += size.astype(np.uint64) * np.uint64(BASES[1 - which])
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return out ^ (out >> np.uint64(32))


def digests(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes & np.uint64((1 << bits) - 1)).view(np.int64)


def plain(documents: DataFrame) -> DataFrame:
    """lang, source and text of all rows, nulls as ''; each row is a document, whatever its id."""
    rows = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.withColumn("text", F.col("text").cast("binary"))


def counted(docs: DataFrame, bits: int) -> DataFrame:
    """(lang, source, term, n, docs) summed over some millions of terms of a task at a time: term is a digest, n its occurrences, docs the documents it is in."""

    def summed(groups: dict, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
        """parts: (group, document, hash) of terms, documents in order."""
        group, doc, term = (np.concatenate(x) for x in zip(*parts, strict=True))
        by_group = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[by_group], np.arange(len(groups) + 1))
        for (lang, source), lo, hi in zip(groups, cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            d, t = doc[by_group[lo:hi]], term[by_group[lo:hi]]
            order = np.argsort(t, kind="stable")
            d, t = d[order], t[order]
            new = np.r_[True, t[1:] != t[:-1]]
            first = np.flatnonzero(new)
            # a term's documents are in order, so that each is counted where it begins
            within = np.add.reduceat(new | np.r_[True, d[1:] != d[:-1]], first, dtype=np.int64)
            yield pd.DataFrame({"lang": lang, "source": source, "term": t[first], "n": np.diff(np.r_[first, len(t)]), "docs": within})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups: dict[tuple[str, str], int] = {}
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held, seen = 0, 0
        for b in batches:
            found = Terms(b" ".join(b["text"]))
            ends = np.cumsum(b["text"].map(len).to_numpy(np.int64) + 1)
            own = np.searchsorted(ends, found.start, side="right")
            group = np.array([groups.setdefault(x, len(groups)) for x in zip(b["lang"], b["source"], strict=True)], np.int32)
            parts.append((group[own], own + seen, digests(found.hashes(), bits)))
            held, seen = held + len(own), seen + len(b)
            if held > HELD:
                yield from summed(groups, parts)
                groups, parts, held = {}, [], 0
        if held:
            yield from summed(groups, parts)

    rows = docs.mapInPandas(run, "lang string, source string, term long, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def filter_table(kept: DataFrame) -> np.ndarray:
    """One bit for each value of the digests' lowest FILTER bits: set if a kept digest has it. 8 MB at every size."""
    place = F.col("term").bitwiseAND(F.lit((1 << FILTER) - 1))
    words = kept.select(F.shiftright(place, 15).alias("at"), place.bitwiseAND(F.lit(0x7FFF)).alias("bit"))
    # each row is 4 KB, and there are 2 ** (FILTER - 15) of them at most
    out = np.zeros((1 << FILTER - 15, 4096), np.uint8)
    for r in words.groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[r["at"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def spelled(docs: DataFrame, kept: DataFrame, bits: int) -> DataFrame:
    """(lang, term, lo, hi) the least and greatest string of each kept digest; they differ where terms collide.

    Strings that no kept digest can belong to never leave their task: a fixed table of bits, which all tasks get, drops
    them; what it lets by in vain goes in the join.
    """
    near = docs.sparkSession.sparkContext.broadcast(filter_table(kept))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = near.value
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            if sum(map(len, seen.values())) > HELD:
                seen = {}
            for lang, rows in b.groupby("lang", sort=False):
                found = Terms(b" ".join(rows["text"]))
                term = digests(found.hashes(), bits)
                low = term & ((1 << FILTER) - 1)
                wanted = np.flatnonzero(marks[low >> 3] >> (low & 7) & 1)
                # strings are told apart by the other hash, so that two of one digest both count
                other, first = np.unique(found.hashes(1)[wanted], return_index=True)
                known = seen.get(lang, np.zeros(0, np.uint64))
                new = ~np.isin(other, known, assume_unique=True)
                seen[lang] = np.union1d(known, other)
                wanted = wanted[first[new]]
                if len(wanted):
                    strings = [found.data[s:e].decode("utf-8", "surrogatepass") for s, e in zip(found.start[wanted], found.end[wanted], strict=True)]
                    yield pd.DataFrame({"lang": lang, "term": term[wanted], "spelling": strings})

    found = docs.mapInPandas(run, "lang string, term long, spelling string")
    strings = found.groupBy("lang", "term").agg(F.min("spelling").alias("lo"), F.max("spelling").alias("hi"))
    return strings.join(kept.select("lang", "term"), ["lang", "term"], "left_semi")


def split_counts(docs: DataFrame, collided: DataFrame, bits: int, min_docs: int) -> DataFrame:
    """(lang, source, term, split, n) of kept terms of collided digests, told apart by their strings (split)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for lang, source, text in zip(b["lang"], b["source"], b["text"], strict=True):
                own = Counter(terms_of(text))
                term = digests(Terms(b" ".join(own)).hashes(), bits).tolist()
                out += [(lang, source, h, t.decode("utf-8", "surrogatepass"), n) for h, (t, n) in zip(term, own.items(), strict=True)]
            if out:
                yield pd.DataFrame(out, columns=["lang", "source", "term", "split", "n"])

    rows = docs.mapInPandas(run, "lang string, source string, term long, split string, n long")
    rows = rows.join(collided.select("lang", "term"), ["lang", "term"], "left_semi")
    found = rows.groupBy("lang", "source", "term", "split").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
    kept = found.groupBy("lang", "term", "split").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    return found.drop("docs").join(kept.drop("docs"), ["lang", "term", "split"], "left_semi")


def share(n: str, total: str, terms: str) -> Column:
    """p = 1 + floor(10^9 (n + 2) / (total + 2 terms)), in decimals: exact for counts up to 10^18."""
    top = f"CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(19,0))"
    return F.expr(f"1 + {top} div CAST({total} + 2 * {terms} AS DECIMAL(20,0))")


def apart(p: str, q: str) -> Column:
    """f = floor((p - q)^2 / (p + q)); p and q are at most 10^9 + 1, so that squares fit in longs."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def divergence(documents: DataFrame, min_docs: int = MIN_DOCS, ranks: int = RANKS, bits: int = BITS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far a source's terms are from other sources' and the language's.

    Counts are shuffled by digests of terms; strings are looked up for kept digests, whose least and greatest string
    show collisions, which are counted again by string; and strings are joined to the rows that are kept at last.

    The sum over all kept terms of a pair of sources is made of what all terms would give if neither source had them,
    of each source's own terms against the other's zero, and of the terms that both have: no table of all terms by all
    sources is made. Null text, lang and source are ''; texts may be of any length and have no terms; rows of one id
    are documents each; other columns are ignored; empty in, empty out.
    """
    spark = documents.sparkSession
    docs = plain(documents)
    counts = materialize(counted(docs, bits), "divergence-counts")
    per_term = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
    kept = materialize(per_term.where(F.col("docs") >= min_docs).select("lang", "term"), "divergence-kept")
    strings = materialize(spelled(docs, kept, bits), "divergence-strings")
    collided = strings.where("lo <> hi")
    clean = strings.where("lo = hi").select("lang", "term")
    rows = counts.drop("docs").join(clean, ["lang", "term"], "left_semi").withColumn("split", F.lit(""))
    if not collided.isEmpty():
        again = split_counts(docs, collided, bits, min_docs)
        rows = rows.unionByName(again.select(*rows.columns))
    rows = materialize(rows, "divergence-rows")
    forget(counts)
    vocabulary = rows.groupBy("lang", "term", "split").agg(F.sum("n").alias("lang_n"))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("total", "v", "lang_total")}
    groups = groups.withColumns(zero)
    # p0: the share of a term that the source has not; without kept terms no share is asked for
    groups = materialize(groups.withColumn("p0", F.when(F.col("v") > 0, share("0L", "total", "v"))), "divergence-groups")
    few = groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    near = F.broadcast(groups) if few else groups
    known = rows.join(near, ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    known = materialize(known.select("lang", "source", "term", "split", "n", "p", "p0", "v", "lang_total"), "divergence-shares")
    return pairs(known, groups, near).unionByName(top_terms(known, vocabulary, strings, ranks))


def pairs(known: DataFrame, groups: DataFrame, near: DataFrame) -> DataFrame:
    """The part `pair`: for each group all other sources of its language."""
    # each group's own terms against the other's p0: terms of one p are one row
    own = known.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
    other = near.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    alone = own.join(other, "lang").where("source <> item")
    alone = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (apart("p", "q0") - apart("p0", "q0"))).alias("gain"))
    # the terms of both
    b = known.select("lang", "term", "split", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    both = known.join(b.hint("merge"), ["lang", "term", "split"]).where("source < item")
    more = apart("p", "q") - apart("p", "q0") - apart("p0", "q") + apart("p0", "q0")
    both = both.groupBy("lang", "source", "item").agg(F.sum(more).alias("gain"))
    mirrored = [x.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "gain") for x in (alone, both)]
    gains = alone.unionByName(mirrored[0]).unionByName(both).unionByName(mirrored[1])
    gains = gains.groupBy("lang", "source", "item").agg(F.sum("gain").alias("gain"))
    nothing = groups.select("lang", "source", "p0", "v").join(near.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang")
    nothing = nothing.where("source <> item").withColumn("base", F.coalesce(F.col("v") * apart("p0", "q0"), F.lit(0).cast("long")))
    out = nothing.join(gains, ["lang", "source", "item"], "left")
    value = (F.col("base") + F.coalesce("gain", F.lit(0).cast("long"))).alias("value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return out.select("lang", "source", F.lit("pair").alias("part"), "item", value).withColumn("rank", rank)


def top_terms(known: DataFrame, vocabulary: DataFrame, strings: DataFrame, ranks: int) -> DataFrame:
    """The part `term`: for each group the terms that are more frequent than in the language, the first ranks only."""
    scored = known.join(vocabulary, ["lang", "term", "split"]).withColumn("q", share("lang_n", "lang_total", "v"))
    scored = scored.where("n > 0 and p > q").select("lang", "source", "term", "split", apart("p", "q").alias("value"))
    scored = materialize(scored, "divergence-scored")
    group = Window.partitionBy("lang", "source")
    # the least value that can be kept; all rows of that value get their string, which decides
    first = scored.withColumn("at", F.row_number().over(group.orderBy(F.col("value").desc()))).where(F.col("at") <= ranks)
    least = first.groupBy("lang", "source").agg(F.min("value").alias("least"))
    some = scored.join(least, ["lang", "source"]).where("value >= least")
    named = some.join(strings.select("lang", "term", "lo"), ["lang", "term"])
    named = named.withColumn("item", F.when(F.col("split") == "", F.col("lo")).otherwise(F.col("split")))
    rank = F.row_number().over(group.orderBy(F.col("value").desc(), "item"))
    out = named.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", rank)
    return out.where(F.col("rank") <= ranks)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of all sources of a language from each other, and the terms that tell a source from its language."""
    return divergence(table(spark, sf_dir, "documents"))
