"""Packing token sequences by cost: longest first to the cheapest sequence that has room."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CAPACITY = 2048
#: Ids that follow each document.
END = 1
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n (attention within the piece).
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Tokens that are packed together: what a task holds at once, 4 bytes each.
POOL = 1 << 21
#: Words, and pieces of words, whose ids a Python worker remembers; beyond that it starts anew.
WORDS = 150_000
#: Python's split() also parts at these; the tokenizer doesn't.
ODD = "\x1c\x1d\x1e\x1f"

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


#: How the tokenizer parts a lower-case word that has none of its special strings.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Words that need no normalization but lower case; the delete character has a letter of its own, so it isn't here.
PLAIN = re.compile("[!-~\x80-\u024f]+")


@cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class WordIds:
    """Ids of a text by a tokenizer whose pieces never reach over white space, word by word from a memory.

    New words are parted into pieces as the tokenizer does it and only the merges of a piece that is new are looked
    up; words with letters beyond Latin, or with the tokenizer's special strings, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def piece(self, piece: str) -> bytes:
        own = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        got = b"".join([t.id.to_bytes(4, "little") for t in self.merge(own)])
        if len(self.pieces) >= WORDS:
            self.pieces.clear()
        self.pieces[piece] = got
        return got

    def word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and "<|" not in word:
            low, pieces = word.lower(), self.pieces
            if low.isalpha():
                got = pieces.get(low) or self.piece(low)
            else:
                got = b"".join([pieces.get(p) or self.piece(p) for p in PIECES.findall(low)])
        else:
            got = self.encode(word)
        if len(self.known) >= WORDS:
            self.known.clear()
        self.known[word] = got
        return got

    def of(self, texts: list[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        known, word = self.known, self.word
        for text in texts:
            if any(c in text for c in ODD):
                yield self.encode(text)
            else:
                yield b"".join([known[w] if w in known else word(w) for w in text.split()])


@cache
def word_ids(path: str) -> WordIds:
    """One memory for all tasks that a Python worker runs."""
    return WordIds(path)


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths.

    Full stretches of `capacity` tokens fill sequences of their own. The rest goes, dearest first, to the cheapest
    open sequence that has room for all of it. Only a piece for which no open sequence has room is cut: it fills up
    the one with most room. There are as many open sequences as the tokens fill, so late pieces are often cut; the
    tokens over go to sequences of the sizes of the powers of two in their number. So no sequence is padded.
    """
    out: list[tuple[int, int, int, int, int]] = []
    rest: list[tuple[int, int, int]] = []
    n = 0
    for d, length in enumerate(lengths):
        whole = length - length % capacity
        for start in range(0, whole, capacity):
            out.append((d, start, capacity, n, 0))
            n += 1
        if length > whole:
            rest.append((length - whole, d, whole))
    tokens = sum(x[0] for x in rest)
    rest.sort(key=lambda x: (-x[0], x[1]))
    costs, room = np.zeros(tokens // capacity), np.full(tokens // capacity, capacity)
    first, n = n, n + len(costs)
    late: list[tuple[int, int, int]] = []
    work = rest[::-1]
    while work:
        length, d, start = work.pop()
        if not room.any():
            late.append((length, d, start))
            continue
        open_ = np.flatnonzero(room >= length)
        s = open_[costs[open_].argmin()] if len(open_) else room.argmax()
        take = min(length, int(room[s]))
        out.append((d, start, take, first + int(s), capacity - int(room[s])))
        room[s] -= take
        costs[s] += cost(take)
        if take < length:
            work.append((length - take, d, start + take))
    # what is over: one sequence for each power of two in its number of tokens
    left = tokens % capacity
    rooms = [1 << b for b in range(capacity.bit_length()) if left >> b & 1]
    room = filled = 0
    for length, d, start in late:
        while length:
            if filled == room:
                room, filled, n = rooms.pop(), 0, n + 1
            take = min(length, room - filled)
            out.append((d, start, take, n - 1, filled))
            filled, length, start = filled + take, length - take, start + take
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of all documents (doc_id, text): see SCHEMA.

    Each task tokenizes its own rows and packs them in pools of two million tokens, so that no text or id is
    shuffled and a lost task is done again by itself; a task holds one pool, or one text's ids where a single text has
    more than that. sequence_id is the task's number and a
    count. A null text counts as empty (its end id alone is packed); repeated rows are packed as separate documents
    with the same doc_id; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = word_ids(tokenizer_path)
        end = END.to_bytes(4, "little")
        first = TaskContext.get().partitionId() << 33
        pool: list[tuple[int | None, bytes]] = []
        held = 0

        def flush() -> pd.DataFrame:
            nonlocal first
            pieces = pack([len(b) // 4 for _, b in pool])
            rows = [
                (pool[d][0], start, n, zlib.crc32(pool[d][1][4 * start : 4 * (start + n)]), len(pool[d][1]) // 4, first + s, o)
                for d, start, n, s, o in pieces
            ]
            first += 1 + max(s for *_, s, _ in pieces)
            columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            out = pd.DataFrame(rows, columns=columns)
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for batch in batches:
            keys = [None if pd.isna(k) else int(k) for k in batch["doc_id"].astype("Int64")]
            for key, b in zip(keys, ids.of(batch["text"].tolist()), strict=True):
                pool.append((key, b + end))
                held += len(b) // 4 + 1
                if held >= POOL:
                    yield flush()
                    pool, held = [], 0
        if pool:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, SCHEMA)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    from public_tokenizers import path

    return pack_documents(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))
