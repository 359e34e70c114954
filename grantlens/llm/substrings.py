"""Repeated passages across documents: shared k-mer seeds, collinear chains, alignment."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_order, materialize, numbered, table, whole_row, with_end

#: Words of a seed; all seeds of a text are kept.
K = 4
#: Long seeds are made of two seeds so many words apart. One in LONG_OF places begins one, by hash alone, and besides the
#: place of the least hash of each LONG_WINDOW in a row: so whatever 50 words are equal have a long seed in common.
LONG_STEP, LONG_OF, LONG_WINDOW = 25, 8, 22
#: Seeds are dealt out by the first BUCKET_BITS bits of their hash, in packs of so many seeds of some documents at most.
BUCKET_BITS, PACK = 12, 1 << 20
#: Places of one seed in a text that are nearer to one another are aligned from the first of them only.
NEAR = 16
#: Cost of each word that a chain skips on either side, and the longest skip within a passage.
GAP_COST, LONGEST_GAP = 0.3, 30
#: Words of a passage at least, and share of its words that match.
MIN_WORDS, SIMILARITY = 50, 0.8
#: Ends of a passage of which a smaller share of words matches are left off.
TRIM = 0.5
#: Words of a chain of seeds at least that is aligned: two seeds, or a long one. Shorter ones are if another is near.
SHORTEST_CHAIN = 2 * K
#: Words round a chain that the alignment may reach into; slices of texts begin and end at multiples of this.
GRID = 64
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def word_codes(text: str) -> np.ndarray:
    """A 32-bit code for each word, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def seeds_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, whether it is a long one) of all k-word seeds, and of the long seeds made of two of them.

    Of 50 words of which 40 are equal, word by word, some 4 in a row are, so that no such passage is without a seed in
    both texts. A long seed tells documents that share a whole passage from such as have a shorter part of it only.
    """
    n = len(codes) - K + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    wide = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for j in range(K):
        h += wide[j : j + n] * MULTIPLIERS[j]
    h = mixed(h)
    long = mixed(h[:-LONG_STEP] * MULTIPLIERS[0] + h[LONG_STEP:] * MULTIPLIERS[1])
    begin = long % np.uint64(LONG_OF) == 0
    if len(long) >= LONG_WINDOW:
        least = np.lib.stride_tricks.sliding_window_view(long, LONG_WINDOW).argmin(axis=1)
        begin[least + np.arange(len(least))] = True
    at = np.flatnonzero(begin)
    kinds = np.repeat([False, True], [n, len(at)])
    return np.concatenate([h, long[at]]).view(np.int64), np.concatenate([np.arange(n), at]), kinds


class Fenwick:
    """Largest value (with its index) among the places before one."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def before(self, i: int) -> tuple[float, int]:
        out = (-np.inf, -1)
        while i:
            out = max(out, self.best[i])
            i -= i & -i
        return out


def chains(a: np.ndarray, b: np.ndarray, k: int = 5, words: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """Chains (a start, a end, b start, b end; ends exclusive) of matched places a, b of seeds of two documents.

    Seeds have k words, or `words` each. Seeds that follow one another on a diagonal are one segment. Segments are
    chained in order on both sides: a segment's score is its words plus the best score before it less the cost of the
    skipped words, found in a Fenwick tree over the ends in b while a is swept. Chains are taken from the best end on;
    each segment is used once, and a chain is cut where it skips more than LONGEST_GAP words.
    """
    order = np.lexsort((a, a - b))
    a, b = a[order], b[order]
    size = np.full(len(a), k) if words is None else words[order]
    new = np.r_[True, (np.diff(a - b) != 0) | (np.diff(a) > LONGEST_GAP)]
    first = np.flatnonzero(new)
    ends_a = np.maximum.reduceat(a + size, first)
    segments = sorted(zip(a[first].tolist(), ends_a.tolist(), b[first].tolist(), (ends_a - a[first] + b[first]).tolist(), strict=True))
    if len(segments) == 1:
        return segments
    n = len(segments)
    ends = sorted({s[3] for s in segments})
    tree = Fenwick(len(ends))
    by_end = sorted(range(n), key=lambda i: segments[i][1])
    score, back = [0.0] * n, [-1] * n
    put = 0
    for i, (a0, a1, b0, _) in enumerate(segments):
        # neighbours may share up to k - 1 words
        while put < n and segments[by_end[put]][1] <= a0 + k - 1:
            j = by_end[put]
            if segments[j][0] < a0 or j < i:
                tree.put(bisect_left(ends, segments[j][3]), (score[j] + GAP_COST * (segments[j][1] + segments[j][3]), j))
            put += 1
        value, j = tree.before(bisect_left(ends, b0 + k))
        gain = value - GAP_COST * (a0 + b0)
        score[i] = a1 - a0
        if gain > 0 and segments[j][2] < b0 and segments[j][0] < a0:
            score[i] += gain
            back[i] = j
    used = [False] * n
    out = []
    for i in sorted(range(n), key=lambda x: -score[x]):
        if used[i]:
            continue
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(segments[i])
            i = back[i]
        chain.reverse()
        run = list(chain[0])
        for a0, a1, b0, b1 in chain[1:]:
            if a0 - run[1] > LONGEST_GAP or b0 - run[3] > LONGEST_GAP:
                out.append(tuple(run))
                run = [a0, a1, b0, b1]
            else:
                run[1], run[3] = max(run[1], a1), max(run[3], b1)
        out.append(tuple(run))
    return out


def runs_of(same: np.ndarray, i: int, j: int) -> list[tuple[int, int, int]]:
    """Stretches (start in a, start in b, words) of true values of a diagonal from i, j on."""
    edges = np.flatnonzero(np.diff(np.r_[False, same, False])).tolist()
    return [(i + s, j + s, e - s) for s, e in zip(edges[::2], edges[1::2], strict=True)]


def between(x: np.ndarray, y: np.ndarray, i: int, j: int) -> list[tuple[int, int, int]]:
    """Stretches of equal words in a gap: on the diagonal of its start up to some word, then on that of its end."""
    n = min(len(x), len(y))
    if not n:
        return []
    front, back = x[:n] == y[:n], x[len(x) - n :] == y[len(y) - n :]
    if len(x) == len(y):
        return runs_of(front, i, j)
    cut = int((np.r_[0, np.cumsum(front)] + np.r_[np.cumsum(back[::-1])[::-1], 0]).argmax())
    return runs_of(front[:cut], i, j) + runs_of(back[cut:], i + len(x) - n + cut, j + len(y) - n + cut)


def follow(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches (start in a, start in b, words) of equal words of an alignment from the start of both on.

    Equal words are followed; where they differ, the nearest place is sought at which three words agree again, and equal
    words on the way there count. What of this is a passage, is for `parts` to say.
    """
    i = j = 0
    blocks = []
    while i < len(a) and j < len(b):
        n, step = min(len(a) - i, len(b) - j), 64
        run = 0
        while run < n:
            part = a[i + run : i + min(n, run + step)] != b[j + run : j + min(n, run + step)]
            if part.any():
                run += int(part.argmax())
                break
            run, step = run + len(part), step * 4
        if run:
            blocks.append((i, j, run))
        i, j = i + run, j + run
        best = None
        x, y = a[i : i + LONGEST_GAP + 3], b[j : j + LONGEST_GAP + 3]
        if len(x) >= 3 and len(y) >= 3:
            same = x[:, None] == y[None, :]
            three = same[:-2, :-2] & same[1:-1, 1:-1] & same[2:, 2:]
            di, dj = np.nonzero(three)
            if len(di):
                k = int((di + dj + np.abs(di - dj)).argmin())
                best = int(di[k]), int(dj[k])
        if best is None or best == (0, 0):
            blocks += between(x[: min(len(x), len(y))], y[: min(len(x), len(y))], i, j)
            break
        blocks += between(x[: best[0]], y[: best[1]], i, j)
        i, j = i + best[0], j + best[1]
    return blocks


def parts(blocks: list[tuple[int, int, int]], min_words: int, similarity: float) -> list[tuple[int, int, int, int, int]]:
    """(a start, a end, b start, b end, matches) of all passages in an alignment's stretches of equal words.

    The longest run of stretches that has min_words and the similarity by itself is a passage; what lies before and
    behind it is searched in the same way. Ends of a passage of which less than the share TRIM matches are left off.
    """
    sa, sb, n = np.array(blocks, dtype=np.int64).reshape(-1, 3).T
    ea, eb, m = sa + n, sb + n, np.r_[0, np.cumsum(n)]
    # stretches x to y are similar enough if both of x's values are at most those of y
    xa, xb = m[:-1] - similarity * sa, m[:-1] - similarity * sb
    ya, yb = m[1:] - similarity * ea + 1e-9, m[1:] - similarity * eb + 1e-9

    def score(x: np.ndarray | int, y: np.ndarray | int) -> np.ndarray:
        wide, narrow = np.maximum(ea[y] - sa[x], eb[y] - sb[x]), np.minimum(ea[y] - sa[x], eb[y] - sb[x])
        got = m[np.asarray(y) + 1] - m[x]
        return np.where((narrow >= min_words) & (got >= similarity * wide - 1e-9), got - TRIM * wide, -np.inf)

    out, todo = [], [(0, len(n))]
    while todo:
        lo, hi = todo.pop()
        best = (0, 0, 0)
        for y in range(hi - 1, lo - 1, -1):
            if min(ea[y] - sa[lo], eb[y] - sb[lo]) < max(min_words, best[0] + 1):
                break
            x = lo + int(((xa[lo : y + 1] <= ya[y]) & (xb[lo : y + 1] <= yb[y])).argmax())
            words = min(ea[y] - sa[x], eb[y] - sb[x])
            if words >= min_words and words > best[0]:
                best = (words, x, y)
        if not best[0]:
            continue
        _, x, y = best
        y = x + int(score(x, np.arange(x, y + 1)).argmax())
        x = x + int(score(np.arange(x, y + 1), y).argmax())
        out.append((int(sa[x]), int(ea[y]), int(sb[x]), int(eb[y]), int(m[y + 1] - m[x])))
        todo += [(lo, x), (y + 1, hi)]
    return out


def may_hold(a: np.ndarray, b: np.ndarray, min_words: int, similarity: float) -> np.ndarray | None:
    """Which words of a lie in a stretch of min_words that shares enough pairs of words with b; None if there is none.

    If the share s of a passage of any length matches, the best of its stretches of n words has m = n * s / (2 - s)
    matches at least; the n - m others part 2 (n - m) of its n - 1 pairs of neighbours at most.
    """
    n = min_words
    if min(len(a), len(b)) < n:
        return None
    x, y = (v[:-1] * np.uint64(MULTIPLIERS[0]) + v[1:] for v in (a.astype(np.uint64), b.astype(np.uint64)))
    y.sort()
    shared = np.r_[0, np.cumsum(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)]
    good = shared[n - 1 :] - shared[: 1 - n] >= n - 1 - 2 * (n - int(n * similarity / (2 - similarity)))
    if not good.any():
        return None
    edge = np.zeros(len(a) + 1, np.int64)
    first = np.flatnonzero(good)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + n, -1)
    return np.cumsum(edge[:-1]) > 0


def align(a: np.ndarray, b: np.ndarray, pins: list[tuple[int, int]], min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> list[tuple[int, int, int, int, int]]:
    """(a start, a end, b start, b end, matches) of the passages round the seeds at pins of two slices.

    Words of a that a passage covers already lead to no other.
    """
    found: list[tuple[int, int, int, int, int]] = []
    hopeful = may_hold(a, b, min_words, similarity)
    if hopeful is None:
        return found
    seen: set[int] = set()
    for at, (a0, b0) in enumerate(pins):
        # a seed that an alignment went through leads to nothing new
        if at in seen or not hopeful[a0] or any(p[0] <= a0 < p[1] for p in found):
            continue
        left = [(a0 - i - n, b0 - j - n, n) for i, j, n in reversed(follow(a[:a0][::-1], b[:b0][::-1]))]
        blocks = left + [(a0 + i, b0 + j, n) for i, j, n in follow(a[a0:], b[b0:])]
        starts = [x[0] for x in blocks]
        for k in range(at, len(pins)):
            i = bisect_right(starts, pins[k][0]) - 1
            if i >= 0 and pins[k][0] < starts[i] + blocks[i][2] and pins[k][0] - pins[k][1] == starts[i] - blocks[i][1]:
                seen.add(k)
        found += parts(blocks, min_words, similarity)
    return found


def pins_of(a: np.ndarray, b: np.ndarray, a0: int, a1: int, b0: int, b1: int) -> list[int]:
    """Places (of a and b by turns) in a chain from which it is aligned: each seed that does not go on from another."""
    own = (a >= a0) & (a < a1) & (b >= b0) & (b < b1)
    a, b = a[own], b[own]
    order = np.lexsort((a, a - b))
    a, b = a[order], b[order]
    new = np.r_[True, (np.diff(a - b) != 0) | (np.diff(a) > K)]
    order = np.argsort(a[new], kind="stable")
    return np.stack([a[new][order], b[new][order]], 1).ravel().tolist()


def planes(x: np.ndarray) -> bytes:
    """Numbers as all their first bytes, all their second ones, and so on: those that are 0 take no room when packed."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def seed_table(docs: DataFrame, bits: int) -> DataFrame:
    """(bucket, base, hashes, places): seeds of all texts of docs (key, text), packed by the first bits of their hashes.

    hashes are the 32 bits behind those of the bucket; base + place is (key << bits | position) << 1, plus 1 for long ones.
    """
    edges = np.arange(1, 1 << BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)

    def packs(h: np.ndarray, at: np.ndarray) -> pd.DataFrame:
        base = int(at.min())
        at = at - base
        at = at.astype("<u4" if int(at.max()) < 1 << 32 else "<u8")
        order = np.argsort(h)
        h, at = h[order], at[order]
        low = (h >> np.uint64(32 - BUCKET_BITS)).astype("<u4")
        cut = np.r_[0, np.searchsorted(h, edges), len(h)].tolist()
        out = [(i, base, low[s:e].tobytes(), planes(at[s:e])) for i, (s, e) in enumerate(zip(cut, cut[1:], strict=False)) if s < e]
        return pd.DataFrame(out, columns=["bucket", "base", "hashes", "places"])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, places, n = [], [], 0
        for b in with_end(batches):
            for key, text in zip(b["key"].tolist(), b["text"], strict=True) if b is not None else ():
                h, at, long = seeds_of(word_codes(text))
                for i in range(0, len(h), PACK):
                    if n + len(h[i : i + PACK]) > PACK:
                        yield packs(np.concatenate(hashes), np.concatenate(places))
                        hashes, places, n = [], [], 0
                    hashes.append(h[i : i + PACK].view(np.uint64))
                    places.append((at[i : i + PACK] + (key << bits)) * 2 + long[i : i + PACK])
                    n += len(hashes[-1])
        if n:
            yield packs(np.concatenate(hashes), np.concatenate(places))

    return docs.select("key", "text").mapInPandas(run, "bucket int, base long, hashes binary, places binary")


def matched(seeds: DataFrame, bits: int) -> DataFrame:
    """(at, rep): each seed with the first place, of another document, that has it too.

    Seeds of one bucket are compared at a time. They are a 4096th of all, whatever seeds are common.
    """

    def first_places(packs: list[tuple]) -> pd.DataFrame:
        n = [len(x[2]) // 4 for x in packs]
        key = np.repeat(np.array([x[0] for x in packs], np.uint64), n) << np.uint64(32)
        key |= np.frombuffer(b"".join(x[2] for x in packs), "<u4")
        at = np.empty(len(key), np.int64)
        s = 0
        for (_, base, _, places), m in zip(packs, n, strict=True):
            width = len(places) // m
            at[s : s + m] = np.frombuffer(places, np.uint8).reshape(width, m).T.copy().view(f"<u{width}")[:, 0]
            at[s : s + m] += base
            s += m
        order = np.argsort(key)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        some = ~new | ~np.r_[new[1:], True]
        at, new = at[order[some]], new[some]
        if not len(at):
            return pd.DataFrame({"at": at, "rep": at})
        starts = np.flatnonzero(new)
        rep = np.repeat(np.minimum.reduceat(at, starts), np.diff(np.r_[starts, len(at)]))
        keep = at >> bits + 1 != rep >> bits + 1
        return pd.DataFrame({"at": at[keep], "rep": rep[keep]})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for b in with_end(batches):
            rows = [] if b is None else list(b.itertuples(index=False, name=None))
            if b is None or rows and held and held[-1][0] != rows[-1][0]:
                # all but the last bucket are complete
                last = rows[-1][0] if rows else None
                ready = held + [x for x in rows if x[0] != last]
                held = [x for x in rows if x[0] == last]
                if ready:
                    yield first_places(ready)
            else:
                held += rows
                if held and held[0][0] != held[-1][0]:
                    last = held[-1][0]
                    yield first_places([x for x in held if x[0] != last])
                    held = [x for x in held if x[0] == last]

    return seeds.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(run, "at long, rep long")


def thinned(a: np.ndarray, c: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches a, c of a pair without places in a that follow another of the same seed nearer than NEAR.

    A text that says a few words over and over is aligned from the places that are left, of which each 50 words have
    some; such a seed counts as two, as it goes on beyond its end.
    """
    order = np.lexsort((a, c))
    a, c, size = a[order], c[order], size[order]
    again = (c[1:] == c[:-1]) & (np.diff(a) < NEAR)
    if not again.any():
        return a, c, size
    keep, size = np.ones(len(a), bool), size.copy()
    for i in np.flatnonzero(again).tolist():
        # i is the kept one, or one that follows it
        j = i if keep[i] else kept
        if a[i + 1] - a[j] < NEAR:
            keep[i + 1], size[j] = False, 2 * K
        kept = j
    return a[keep], c[keep], size[keep]


def hopeful_chains(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Chains of SHORTEST_CHAIN words and more, and shorter ones that have another within a passage's length of them."""
    found = sorted(found)
    good = [min(x[1] - x[0], x[3] - x[2]) >= SHORTEST_CHAIN for x in found]
    for i in range(1, len(found)):
        if not (good[i] and good[i - 1]):
            for j in range(i - 1, -1, -1):
                if found[i][0] - found[j][0] > MIN_WORDS:
                    break
                if abs(found[i][2] - found[j][2]) <= MIN_WORDS:
                    good[i] = good[j] = True
                    break
    return [x for x, y in zip(found, good, strict=True) if y]


def chain_table(matches: DataFrame, bits: int) -> DataFrame:
    """Chains of all pairs of matches (at, rep): doc, other, a0, a1, b0, b1, pins (places in both texts by turns)."""
    mask = (1 << bits) - 1

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail: list[np.ndarray] = []
        for b in with_end(batches):
            if b is None:
                if not tail:
                    return
                rows, tail = np.concatenate(tail), []
            else:
                rows = b.to_numpy()
                if not len(rows):
                    continue
                last = ((rows ^ rows[-1]) >> bits + 1 == 0).all(axis=1)
                if last.all() and tail and ((rows[-1] ^ tail[-1][-1]) >> bits + 1 == 0).all():
                    tail.append(rows)
                    continue
                rows, tail = np.concatenate([*tail, rows[~last]]), [rows[last]]
                if not len(rows):
                    continue
            x, y = rows.T >> bits + 1
            a, c = rows.T >> 1 & mask
            size = np.where(rows[:, 0] & 1, 2 * K, K)
            starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            ends = np.r_[starts[1:], len(x)]
            some = np.add.reduceat(size, starts) >= SHORTEST_CHAIN
            out = []
            for s, e in zip(starts[some].tolist(), ends[some].tolist(), strict=True):
                p, q, words = thinned(a[s:e], c[s:e], size[s:e])
                for a0, a1, b0, b1 in hopeful_chains(chains(p, q, K, words)):
                    out.append((x[s], y[s], a0, a1, b0, b1, pins_of(p, q, a0, a1, b0, b1)))
            if out:
                yield pd.DataFrame(out, columns=["doc", "other", "a0", "a1", "b0", "b1", "pins"])

    pair = F.shiftright("at", bits + 1), F.shiftright("rep", bits + 1)
    # a document has one match for each of its seeds at most, so no pair's rows are many
    dealt = matches.repartition(*pair).sortWithinPartitions(*pair)
    return dealt.mapInPandas(run, "doc long, other long, a0 int, a1 int, b0 int, b1 int, pins array<int>")


def slices(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, s, e, codes) word codes of stretches; wanted: doc, s, e, distinct."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 200):
                out = []
                for key, text, spans in zip(b["doc"][i : i + 200], b["text"][i : i + 200], b["spans"][i : i + 200], strict=True):
                    codes = word_codes(text)
                    for x in spans:
                        out.append((key, x["s"], x["e"], codes[x["s"] : x["e"]].tobytes()))
                yield pd.DataFrame(out, columns=["doc", "s", "e", "codes"])

    # a document's stretches lie on a grid, so that they are few however many documents ask for them
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    texts = docs.select(F.col("key").alias("doc"), "text").join(lists.hint("merge"), "doc")
    return texts.mapInPandas(run, "doc long, s int, e int, codes binary")


def on_grid(start: str, end: str) -> tuple:
    """A stretch with room round it: start on the grid, length a power of two of grid steps."""
    s = F.greatest(F.lit(0), F.floor((F.col(start) - GRID) / GRID)) * GRID
    steps = F.ceil((F.col(end) + GRID - s) / GRID)
    length = F.pow(F.lit(2.0), F.ceil(F.log2(steps.cast("double")))) * GRID
    return s.cast("int"), (s + length).cast("int")


RESULT = "start_word int, end_word int, other_start int, other_end int, n_words int, similarity double"


def keyed_passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of docs (key, text; keys count from 0) that a document of smaller key has too: doc, other and RESULT."""
    size = docs.agg(F.max("key"), F.max(F.octet_length("text"))).first()
    bits = max(8, int((size[1] or 0) // 2 + 2).bit_length())
    if (size[0] or 0).bit_length() + bits > 62:
        raise ValueError("too many documents for texts of this length")
    found = materialize(chain_table(matched(seed_table(docs, bits), bits), bits), "chains")
    return covering(aligned(docs, found, min_words, similarity))


def passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of docs (doc_id, text) that an earlier row, by doc_id, has too.

    Returns doc_id, start_word, end_word (exclusive), other_doc_id, other_start, other_end, n_words, similarity. The
    first row that has a seed stands for all that share it, so that a passage in n documents gives n - 1 passages and
    not all pairs; long seeds see to it that a row which has a part of a passage only doesn't hide it between others.
    similarity is matched words over the longer side.

    Every row is a document of its own: rows of one doc_id are compared like others, in order of their texts' hash,
    and their passages carry that id; rows without doc_id come last, and their passages carry null. Null and empty texts have no passages; a passage repeated within one row only is
    not returned; a very long text is held in one task, whole; other columns are ignored; empty in, empty out.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = numbered(in_order(ids, "doc_id"), "passages")
    found = materialize(told_once(keyed_passages(rows, min_words, similarity)), "found")
    # only the ids of documents with passages are looked up
    names = rows.select("key", "doc_id")
    named = found.join(names.select(F.col("key").alias("doc"), "doc_id"), "doc")
    named = named.join(names.select(F.col("key").alias("other"), F.col("doc_id").alias("other_doc_id")), "other")
    return named.select("doc_id", "start_word", "end_word", "other_doc_id", "other_start", "other_end", "n_words", "similarity")


def covering(found: DataFrame) -> DataFrame:
    """Of each two documents' passages those that cover the words of all: texts that repeat themselves match at many shifts."""
    columns = found.columns
    rest = [c for c in columns if c not in ("doc", "other")]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, other, spans in zip(b["doc"], b["other"], b["spans"], strict=True):
                kept: list = []
                for x in sorted(spans, key=lambda x: (x["start_word"], -x["end_word"], x["other_start"], x["other_end"])):
                    if kept and x["end_word"] <= kept[-1]["end_word"]:
                        continue
                    while len(kept) > 1 and x["start_word"] <= kept[-2]["end_word"]:
                        kept.pop()
                    kept.append(x)
                out += [{"doc": doc, "other": other} | {c: x[c] for c in rest} for x in kept]
            yield pd.DataFrame(out, columns=columns)

    lists = found.groupBy("doc", "other").agg(F.collect_list(F.struct(*rest)).alias("spans"))
    return lists.mapInPandas(run, found.schema)


def told_once(found: DataFrame) -> DataFrame:
    """found without equal passages that, but for under K words, an equal one of an earlier document holds already.

    All three documents have these words, so that the later pair is told by the pairs of either with the earliest.
    """
    columns = found.columns
    rest = [c for c in columns if c != "doc"]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, spans in zip(b["doc"], b["spans"], strict=True):
                held: list[tuple[int, int]] = []
                for x in sorted(spans, key=lambda x: (x["other"], x["start_word"])):
                    s, e = x["start_word"], x["end_word"]
                    if x["similarity"] == 1 and any(e - s - (min(e, v) - max(s, u)) < K for u, v in held):
                        continue
                    if x["similarity"] == 1:
                        held.append((s, e))
                    out.append({"doc": doc} | {c: x[c] for c in rest})
            yield pd.DataFrame(out, columns=columns)

    lists = found.groupBy("doc").agg(F.collect_list(F.struct(*rest)).alias("spans"))
    return lists.mapInPandas(run, found.schema)


def aligned(docs: DataFrame, found: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """The passages, as `passages` returns them, round chains (as of chain_table)."""
    (sa, ea), (sb, eb) = on_grid("a0", "a1"), on_grid("b0", "b1")
    found = materialize(found.withColumns({"sa": sa, "ea": ea, "sb": sb, "eb": eb}), "asked")
    wanted = found.select("doc", F.col("sa").alias("s"), F.col("ea").alias("e")).unionByName(
        found.select(F.col("other").alias("doc"), F.col("sb").alias("s"), F.col("eb").alias("e"))
    )
    cut = materialize(slices(docs, wanted.distinct()).dropDuplicates(["doc", "s", "e"]), "slices")
    left = cut.select(F.col("doc"), F.col("s").alias("sa"), F.col("e").alias("ea"), F.col("codes").alias("a"))
    right = cut.select(F.col("doc").alias("other"), F.col("s").alias("sb"), F.col("e").alias("eb"), F.col("codes").alias("b"))
    both = found.join(left, ["doc", "sa", "ea"]).join(right, ["other", "sb", "eb"])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for r in p.itertuples(index=False):
                a, b = np.frombuffer(r.a, np.uint32), np.frombuffer(r.b, np.uint32)
                pins = [(x - r.sa, y - r.sb) for x, y in zip(r.pins[::2], r.pins[1::2], strict=True)]
                for a0, a1, b0, b1, matched in align(a, b, pins, min_words, similarity):
                    n = max(a1 - a0, b1 - b0)
                    out.append((r.doc, r.other, a0 + r.sa, a1 + r.sa, b0 + r.sb, b1 + r.sb, a1 - a0, matched / n))
            yield pd.DataFrame(out, columns=["doc", "other", *(c.split()[0] for c in RESULT.split(", "))])

    return both.mapInPandas(run, f"doc long, other long, {RESULT}").distinct()


def without_passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, length: str | None = None) -> DataFrame:
    """docs (any columns) with repeated passages cut from all rows but the first, by doc_id, of each.

    `length` names a column of the text's length, if there is one, which then follows cut texts.

    Rows are told apart by themselves and not by doc_id, which may repeat or be null. Texts keep their white space
    round what is left. A row of which no word is left goes; one that had no word before stays.
    """
    import re

    named = docs.select(whole_row(docs), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = numbered(in_order(named, "doc_id").drop("doc_id"), "cut")
    found = keyed_passages(rows, min_words, similarity)
    spans = found.groupBy("doc").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
        out = []
        for text, marks in zip(texts, all_spans, strict=True):
            if marks is None or text is None or not len(marks):
                out.append(text)
                continue
            words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            kept, at = [], 0
            for s, e in sorted((x["start_word"], x["end_word"]) for x in marks):
                e = min(e, len(words))
                if s >= e:
                    continue
                begin, end = words[s][0], words[e - 1][1]
                if begin > at:
                    kept.append(text[at:begin])
                at = max(at, end)
            kept.append(text[at:])
            left = "".join(kept)
            out.append(left if left.strip(" \t\n\r\x0b\x0c") else None)
        return pd.Series(out, dtype=object)

    # else the optimizer copies the cut into the condition, and texts are cut twice, by two Python workers of a task
    cut = cut.asNondeterministic()
    joined = rows.drop("text").join(spans.withColumnRenamed("doc", "key").hint("merge"), "key", "left")
    had = F.col("spans").isNotNull()
    text = F.when(had, cut("row.text", "spans")).otherwise(F.col("row.text"))
    out = joined.withColumn("text", text).where(~had | F.col("text").isNotNull())
    new = {"text": F.col("text")}
    if length in docs.columns:
        new[length] = F.when(had, F.length("text").cast("long")).otherwise(F.col(f"row.{length}"))
    return out.select(*[new.get(c, F.col("row.`" + c.replace("`", "``") + "`")).alias(c) for c in docs.columns])


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more of all documents that an earlier document has too."""
    return passages(table(spark, sf_dir, "documents"))
