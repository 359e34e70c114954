"""Conversation repair against an exhaustive search and a plain program over rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from grantlens.llm import repair as rep

CONVERSATIONS = "conv_id long, turn long, role string, text string, audit string"
SHAPE = re.compile(r"(s?(ua)+)?")


def exhaustive(rows, longest):
    """Least (cost, audit) over all ways with at most `longest` letters."""
    best = None
    todo = [(0, "", 0, "")]
    while todo:
        i, roles, cost, audit = todo.pop()
        if best is not None and cost > best[0] or len(audit) > longest:
            continue
        if i == len(rows) and SHAPE.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        todo += [(i, roles + r, cost + 3, audit + "I") for r in "ua"]
        if i < len(rows):
            r = rows[i]
            todo.append((i + 1, roles, cost + 4, audit + "D"))
            if not r & 8:
                late = 3 if r & 4 else 0
                todo.append((i + 1, roles + ".sua"[r & 3], cost + late, audit + "K"))
                todo += [(i + 1, roles + x, cost + late + 3, audit + "R") for x in "ua"]
    return best


@pytest.mark.parametrize("seed", range(40))
def test_solve_equals_exhaustive_search(seed):
    r = random.Random(seed)
    rows = bytes(r.choice([1, 2, 3, 2, 3, 0, 6, 7, 10, 11, 8, 5]) for _ in range(r.randint(0, 3)))
    assert rep.solve(rows) == exhaustive(rows, len(rows) + 2)


def by_states(rows):
    """The same by a table of the best (cost, audit) for each state, row after row."""
    turn = {0: 2, 1: 2, 2: 3, 3: 2}

    def grown(ways):
        todo = list(ways.items())
        while todo:
            s, (c, a) = todo.pop()
            way = (c + 3, a + "I")
            if turn[s] not in ways or way < ways[turn[s]]:
                ways[turn[s]] = way
                todo.append((turn[s], way))
        return ways

    ways = grown({0: (0, "")})
    for r in rows:
        new = {}
        for s, (c, a) in ways.items():
            moves = [(s, c + 4, "D")]
            if not r & 8:
                late = 3 if r & 4 else 0
                moves.append((turn[s], c + late + 3, "R"))
                if r & 3 == turn[s] or r & 3 == 1 and s == 0:
                    moves.append((r & 3, c + late, "K"))
            for t, cost, letter in moves:
                if t not in new or (cost, a + letter) < new[t]:
                    new[t] = (cost, a + letter)
        ways = grown(new)
    return min(ways[s] for s in (0, 3) if s in ways)


@pytest.mark.parametrize("seed", range(60))
def test_pieces_equal_the_table_of_states(seed, monkeypatch):
    r = random.Random(seed)
    kinds = r.choice([[1, 2, 3, 0, 6, 7, 10, 11, 8], [2, 3], [2], [3], [1], [2, 6], [3, 7, 6], [2, 2, 2, 3, 10]])
    rows = bytes(r.choice(kinds) for _ in range(r.randint(0, 300)))
    want = by_states(rows)
    assert rep.repair(rows) == want
    monkeypatch.setattr(rep, "PIECE", 7)
    assert rep.repair(rows) == want


def test_bounds_never_exceed_costs():
    for n in range(4):
        for rows in itertools.product([0, 1, 2, 3, 6, 7, 8, 4], repeat=n):
            rows = bytes(rows)
            for ends, tail in (((0, 3), True), ((1,), False), ((2,), False), ((0,), False)):
                bounds = rep.suffix_bounds(rows, ends, tail)
                for i, start in itertools.product(range(n + 1), range(4)):
                    found = rep.solve(rows[i:], start, ends, tail)
                    assert min(bounds[i][start], rep.NEVER) <= (found[0] if found else rep.NEVER)


def plain_report(rows):
    """rows: (conv_id, turn, role, text), no two of one turn."""
    out = {}
    for conv in {x[0] for x in rows}:
        kept = []
        for _, turn, role, text in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1])):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(turn, role, text)] * (2 if kind == 3 else 1)
        faults, seen, codes = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in kept:
            code = {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            if not bare:
                faults["blank"] += 1
                code += 8
            elif (role, text) in seen:
                faults["duplicate"] += 1
                code += 8
            elif bare[-1] not in ".!?":
                faults["truncated"] += 1
                code += 4
            seen.add((role, text))
            codes.append(code)
        turns = {t for t, _, _ in kept if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit = by_states(bytes(codes))
        done, state, i = [], "", 0
        for letter in audit:
            role = "assistant" if state == "u" else "user"
            if letter == "I":
                done.append((role, ""))
            else:
                if letter != "D":
                    done.append((kept[i][1] if letter == "K" else role, kept[i][2]))
                i += 1
            state = done[-1][0][0] if done else ""
        assert i == len(kept) and SHAPE.fullmatch("".join(x[0][0] for x in done))
        text = "\n".join(f"{a}:{b}" for a, b in done)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def reported(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_report_equals_brute_force(spark):
    r = random.Random(3)
    rows = []
    for conv in [*range(150), None, 2**60 + 1]:
        for turn in [*sorted(r.sample(range(-3, 20), r.randint(1, 9))), *([None] if r.random() < 0.1 else [])]:
            role = r.choice(["user", "assistant"] * 6 + ["system", "tool", "", None])
            text = r.choice(["Well. ", "yes!\n", "no", "Was it?", "", " \n", None, f"text {turn}.", "Ét… .", "a.b"])
            rows.append((conv, turn, role, text))
    df = spark.createDataFrame([(*x, "clash") for x in rows], CONVERSATIONS).repartition(5)
    assert reported(rep.report(rep.damaged(df))) == plain_report(rows)


def test_a_long_conversation(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"Text {i % 97}{'.' if i % 13 else ''}") for i in range(9000)]
    df = spark.createDataFrame([(*x, "") for x in rows], CONVERSATIONS).repartition(7)
    assert reported(rep.report(rep.damaged(df))) == plain_report(rows)


def test_edges(spark):
    assert rep.report(rep.damaged(spark.createDataFrame([], CONVERSATIONS))).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    whole = next(i for i in range(1000) if zlib.crc32(f"{i}:4".encode()) % 20 > 4)
    twice = [(whole, 4, "user", "x." * 100_000, ""), (whole, 4, "user", "x." * 100_000, "")]
    got = reported(rep.report(rep.damaged(spark.createDataFrame([(gone, 1, "user", "Hm.", ""), *twice], CONVERSATIONS))))
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[whole][:-1] == (0, 0, 1, 0, 1, 7, "KDI")


def test_repaired_rows_alternate(spark):
    rows = [(1, 0, "system", "Be brief.", ""), (1, 1, "assistant", "Hello.", ""), (1, 2, "assistant", "Hello.", ""), (1, 3, "user", "Why?", "")]
    got = rep.repaired(spark.createDataFrame(rows, CONVERSATIONS)).collect()
    assert SHAPE.fullmatch("".join(x.role[0] for x in got)) and len(got) >= 3
