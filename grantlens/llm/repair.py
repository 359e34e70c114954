"""Conversation structure repair: the cheapest edits that make roles alternate, by depth-first branch and bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, table

#: What an edit costs; a truncated row that stays costs TRUNCATED more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Where a sequence of roles stands: nothing yet, after a system row, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: For each state the role that may follow and the state behind it; a kept system row may only be the first.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ACCEPTED = (START, ASSISTANT)
#: Rows that are solved at once. Longer conversations are solved piece by piece, from each state to each.
PIECE = 256

# a row's code: its role's initial (0 other, 1 system, 2 user, 3 assistant), plus 4 if truncated, plus 8 if it must go
MUST_GO, CUT_OFF = 8, 4
NAMES = {USER: "user", ASSISTANT: "assistant"}


NEVER = 1 << 40


def suffix_bounds(rows: bytes, ends: tuple[int, ...] = ACCEPTED, tail: bool = True) -> list[list[int]]:
    """Least costs of rows[i:] from each state on, of a laxer problem: a system row leaves the start as it was.

    So what follows a system row may also be nothing or another system row, and a node's bound is never over its cost.
    """
    last = [NEVER] * 4
    for s in ends:
        last[START if s == SYSTEM else s] = 0
    inserted(last, tail)
    out = [last]
    for r in reversed(rows):
        then, now = out[-1], [NEVER] * 4
        stay, role = (TRUNCATED if r & CUT_OFF else 0), r & 3
        for s in (START, USER, ASSISTANT):
            after = TURN[s]
            now[s] = DELETE + then[s]
            if not r & MUST_GO:
                now[s] = min(now[s], stay + REROLE + then[after])
                if role == after or role == SYSTEM and s == START:
                    now[s] = min(now[s], stay + KEEP + then[START if role == SYSTEM else role])
        inserted(now, True)
        out.append(now)
    return out[::-1]


def inserted(costs: list[int], allowed: bool) -> None:
    """costs of states, lowered by what inserted rows lead to; SYSTEM's are those of START."""
    if allowed:
        for _ in range(2):
            for s in (START, USER, ASSISTANT):
                costs[s] = min(costs[s], INSERT + costs[TURN[s]])
    costs[SYSTEM] = costs[START]


def solve(rows: bytes, start: int = START, ends: tuple[int, ...] = ACCEPTED, tail: bool = True) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of rows from one state into one of `ends`, ties ASCII-least; None if there are none.

    Depth first with an explicit stack of (row, state, cost, audit so far). A node goes if its cost with the least cost
    of the rows that are left is over the incumbent's, or equal with a greater audit; or if its place (row, state) was
    reached before at the same or less (cost, audit): prefixes of equal cost over the same rows are never prefixes of
    one another, so that the lesser one leads to the lesser audit. `tail`: rows may be inserted behind the last.
    """
    bounds = suffix_bounds(rows, ends, tail)
    n = len(rows)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")] if bounds[0][start] < NEVER else []
    while stack:
        i, state, cost, audit = stack.pop()
        if best is not None:
            least = cost + bounds[i][state]
            if least > best[0] or least == best[0] and audit > best[1][: len(audit)]:
                continue
        known = table.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        table[i, state] = (cost, audit)
        if i == n and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        after = TURN[state]
        children = []
        if i < n or tail:
            children.append((cost + INSERT + bounds[i][after], "I", (i, after, cost + INSERT, audit + "I")))
        if i < n:
            r = rows[i]
            children.append((cost + DELETE + bounds[i + 1][state], "D", (i + 1, state, cost + DELETE, audit + "D")))
            if not r & MUST_GO:
                stay = cost + (TRUNCATED if r & CUT_OFF else 0)
                role = r & 3
                if role == after or role == SYSTEM and state == START:
                    children.append((stay + KEEP + bounds[i + 1][role], "K", (i + 1, role, stay + KEEP, audit + "K")))
                children.append((stay + REROLE + bounds[i + 1][after], "R", (i + 1, after, stay + REROLE, audit + "R")))
        # the most hopeful is looked at first; what leads to no end is left out
        children = [c for c in children if c[0] < NEVER]
        children.sort(reverse=True)
        stack.extend(c[2] for c in children)
    return best


@lru_cache(maxsize=8192)
def solved(rows: bytes, start: int, ends: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    return solve(rows, start, ends, tail)


def repair(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation.

    One of up to PIECE rows is solved at once. Of a longer one each piece is solved from each state to each state, and
    the cheapest ways to the states are carried on; what all ways have in common is set aside, so that they stay short.
    """
    if len(rows) <= PIECE:
        return solved(rows, START, ACCEPTED, True)
    ways: dict[int, tuple[int, str]] = {START: (0, "")}
    done: list[str] = []
    for at in range(0, len(rows), PIECE):
        piece = rows[at : at + PIECE]
        last = at + PIECE >= len(rows)
        new: dict[int, tuple[int, str]] = {}
        for state, (cost, audit) in ways.items():
            for end in ACCEPTED if last else range(4):
                found = solved(piece, state, (end,), last)
                if found is not None:
                    way = (cost + found[0], audit + found[1])
                    if end not in new or way < new[end]:
                        new[end] = way
        first, other = min(w[1] for w in new.values()), max(w[1] for w in new.values())
        same = next((k for k, (x, y) in enumerate(zip(first, other, strict=False)) if x != y), min(len(first), len(other)))
        done.append(first[:same])
        ways = {s: (c, a[same:]) for s, (c, a) in new.items()}
    cost, audit = min(ways.values())
    return cost, "".join(done) + audit


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, dropped) after damage by crc32(conv_id:turn) % 20; nulls there are one space.

    0 drops the row (it stays as a marker), 1 empties its text, 2 removes its .!? characters, 3 doubles the row,
    4 makes its role user. Null roles and texts are one space, too.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "text": changed})
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"), copies.alias("_copy")).drop("_copy")


def digests() -> list[Column]:
    """Two 64-bit digests of role and text: rows of one turn stand in their order, and rows that are equal have equal ones."""
    return [F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2")]


def codes() -> Column:
    """A row's code but for repeats: initial of the role, + 4 truncated, + 8 blank (then + 32, to be told from repeats)."""
    initial = F.when(F.col("role").startswith("s"), SYSTEM).when(F.col("role").startswith("u"), USER).when(F.col("role").startswith("a"), ASSISTANT).otherwise(0)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(~F.col("text").rlike(WORD), initial + 40).when(~last.isin(".", "!", "?"), initial + CUT_OFF).otherwise(initial)


#: Rows without turn come first, as nulls do in Spark.
ORDER = ["conv_id", "turn", "h1", "h2"]


def named() -> Column:
    """conv_id as text: pandas would make longs with nulls doubles."""
    return F.col("conv_id").cast("string").alias("conv_id")


def grouped(batches: Iterable[pd.DataFrame], key: str) -> Iterator[tuple[str | None, pd.DataFrame, bool]]:
    """(key or None, rows, whether they are the key's last) of a sorted stream: pieces of one key follow each other."""
    waiting = None
    for b in batches:
        if not len(b):
            continue
        k = b[key]
        new = np.flatnonzero(((k != k.shift()) & ~(k.isna() & k.shift().isna())).to_numpy())
        new = [0, *[x for x in new.tolist() if x]]
        for s, e in zip(new, [*new[1:], len(b)], strict=True):
            name = None if pd.isna(k.iloc[s]) else k.iloc[s]
            part = b.iloc[s:e]
            if waiting is not None:
                same = waiting[0] == name
                yield waiting[0], waiting[1], not same
            waiting = (name, part)
    if waiting is not None:
        yield waiting[0], waiting[1], True


SUMMARY = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def summaries(rows: DataFrame) -> DataFrame:
    """Of rows (damaged) for each conversation SUMMARY. Only digests and codes of rows are shuffled, not texts.

    A conversation's rows pass one task in order; it holds one byte for each.
    """
    facts = rows.select("conv_id", "turn", "dropped", *digests(), codes().cast("tinyint").alias("code"))
    dealt = facts.repartition("conv_id")
    # the exchange by conversation serves the repeats, too
    again = F.row_number().over(Window.partitionBy("conv_id", "h1", "h2", "dropped").orderBy(F.col("turn").asc_nulls_first())) > 1
    flagged = dealt.withColumn("code", F.when(again & (F.col("code") < 32), (F.col("code") % 4 + 24).cast("tinyint")).otherwise(F.col("code")))
    sorted_rows = flagged.sortWithinPartitions(*ORDER).select(named(), F.col("turn").cast("string").alias("turn"), "dropped", "code")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        held = bytearray()
        low = high = before = None
        n_turns = 0
        for name, part, last in grouped(batches, "conv_id"):
            part = part[~part["dropped"].to_numpy(bool)]
            held += part["code"].to_numpy(np.uint8).tobytes()
            turns = [int(x) for x in part["turn"].dropna()]
            if turns:
                low, high = (turns[0] if low is None else low), turns[-1]
                n_turns += sum(x != y for x, y in zip(turns, [before, *turns[:-1]], strict=True))
                before = turns[-1]
            if last:
                c = np.frombuffer(bytes(held), np.uint8)
                initial = c & 3
                pairs = initial[:-1] * 4 + initial[1:]
                fine = np.isin(pairs, [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
                cost, audit = repair((c & 15).tobytes())
                gaps = 0 if low is None else high - low + 1 - n_turns
                out.append((name, gaps, int((c >= 32).sum()), int((c & 16 > 0).sum()), int((c & CUT_OFF > 0).sum()), int((~fine).sum()), cost, audit))
                held, low, high, before, n_turns = bytearray(), None, None, None, 0
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=NAMES_OF_SUMMARY)
                    out = []
        yield pd.DataFrame(out, columns=NAMES_OF_SUMMARY)

    found = sorted_rows.mapInPandas(run, SUMMARY)
    return found.withColumn("conv_id", F.col("conv_id").cast("long"))


NAMES_OF_SUMMARY = [x.split()[0] for x in SUMMARY.split(", ")]


def edits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """What is done to each of rows (damaged), in order, as (conv_id, edit, role, text): K, R, D, and I for new rows.

    An audit is sent ahead of its conversation's rows; rows pass one by one, whatever the conversation's length.
    """
    marks = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(True).alias("mark"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit("").alias("role"), F.col("audit").alias("text"))
    kept = rows.where(~F.col("dropped")).select("conv_id", "turn", F.lit(False).alias("mark"), *digests(), "role", "text")
    both = marks.unionByName(kept).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", F.col("mark").desc(), *ORDER[1:]).select(named(), "mark", "role", "text")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, state = "", 0, START
        for b in batches:
            out: list[tuple] = []

            def inserts(name: object, out: list[tuple] = out) -> None:
                nonlocal at, state
                while at < len(audit) and audit[at] == "I":
                    state = TURN[state]
                    out.append((name, "I", NAMES[state], ""))
                    at += 1

            for name, mark, role, text in zip(b["conv_id"], b["mark"], b["role"], b["text"], strict=True):
                if mark:
                    audit, at, state = text, 0, START
                    inserts(name)
                    continue
                edit = audit[at]
                at += 1
                if edit != "D":
                    state = SYSTEM if edit == "K" and role.startswith("s") else TURN[state]
                out.append((name, edit, NAMES[state] if edit == "R" else role, text))
                inserts(name)
            yield pd.DataFrame(out, columns=["conv_id", "edit", "role", "text"])

    return ordered.mapInPandas(run, "conv_id string, edit string, role string, text string")


def hashes(done: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of edits, as `edits` returns them: rows of a conversation are in order in one partition."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        h, some = hashlib.sha256(), False
        for name, part, last in grouped(batches, "conv_id"):
            for edit, role, text in zip(part["edit"], part["role"], part["text"], strict=True):
                if edit != "D":
                    h.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
            if last:
                out.append((name, h.hexdigest()))
                h, some = hashlib.sha256(), False
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
                    out = []
        yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])

    hashed = done.mapInPandas(run, "conv_id string, repaired_sha256 string")
    return hashed.withColumn("conv_id", F.col("conv_id").cast("long"))


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, role, text), in order within each partition; conversations (conv_id, turn, role, text) are as they are."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", "turn", text("role"), text("text"), F.lit(False).alias("dropped"))
    return edits(rows, materialize(summaries(rows), "repair")).where("edit <> 'D'").select(F.col("conv_id").cast("long").alias("conv_id"), "role", "text")


def report(rows: DataFrame) -> DataFrame:
    """SUMMARY and repaired_sha256 of each conversation of rows (as of `damaged`).

    Rows of one turn are put in the order of digests of role and text; rows that are equal in all stand next to each
    other, the later ones are duplicates. Rows without conv_id are one conversation, null. Null and empty texts are
    blank. A conversation of which no row is left has zeros, no audit and the hash of nothing. Very long texts pass
    alone; a very long conversation's rows pass one task one after another, since its hash is over all of them in
    order, in memory of one byte for each. Other columns are ignored; empty in, empty out.
    """
    found = materialize(summaries(rows), "repair")
    hashed = hashes(edits(rows, found)).withColumnRenamed("conv_id", "_conv")
    joined = found.join(hashed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: faults, the cheapest repair's cost and audit, and the hash of what it gives."""
    return report(damaged(table(spark, sf_dir, "conversations")))
