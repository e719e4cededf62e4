"""Conversation repair against an exhaustive search."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from twinfold.llm import conversations as cv
from twinfold.llm.queries import op13_query

GOAL = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired) by trying edits in order of cost and letters.

    Independent of the operator: a state is the row reached and the initials so far, cut to what
    decides on the rest.
    """
    faults = faults_of(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, initials, out = heapq.heappop(heap)
        if (at, initials[-1:]) in done:
            continue
        done.add((at, initials[-1:]))
        if at == len(rows) and GOAL.fullmatch(initials):
            return cost, audit, out

        def push(price, letter, step, role=None, text=None):
            now = initials if role is None else initials + role[:1]
            if role is not None and not any(GOAL.fullmatch(now + rest) for rest in ("", "a", "ua")):
                return
            said = out if role is None else (*out, f"{role}:{text}")
            heapq.heappush(heap, (cost + price, audit + letter, at + step, now, said))

        for role in ("user", "assistant"):
            push(5, "I", 0, role, "")
        if at < len(rows):
            role, text = rows[at]
            push(2, "D", 1)
            if faults[at] not in ("blank", "duplicate"):
                more = 5 * (faults[at] == "truncated")
                if role[:1] in ("s", "u", "a"):
                    push(more, "K", 1, role, text)
                for other in ("user", "assistant"):
                    push(1 + more, "R", 1, other, text)


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = None
        if not shown:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif shown[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        found.append(fault)
    return found


def expected(table):
    """Rows of the query for a list of (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in rows if t is not None]
        said = [(r, t) for _, r, t in rows]
        faults = faults_of(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, repaired = cheapest(said)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return out


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
DDL = "conv_id long, turn long, role string, text string, conv string, chunk string, kind string"


def drawn(seed, convs=40, most=14):
    draw = random.Random(seed)
    roles = draw.choice([["user", "assistant"], ["user", "assistant", "system", "tool", "", None, "usher"], ["tool"]])
    rows = []
    for conv in range(convs):
        for turn in range(draw.randrange(1, most)):
            if draw.random() < 0.9:
                text = draw.choice(["yes.", "no!", "why? ", "half", " ", "", None, "Ein Satz。", f"{draw.random()}."])
                at = None if draw.random() < 0.05 else turn + 3 * (draw.random() < 0.1)
                role = roles[turn % min(2, len(roles))] if draw.random() < 0.6 else draw.choice(roles)
                rows.append((conv, at, role, text, "c", "k", "z"))
    rows += [(None, 1, "user", "a.", None, None, None), (None, None, None, None, None, None, None)]
    return rows


def found_by(spark, rows):
    return [tuple(r) for r in op13_query(spark.createDataFrame(rows, DDL)).select(*COLUMNS).collect()]


def same(found, rows):
    want = expected([r[:4] for r in rows])
    assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_edits(spark, seed):
    rows = drawn(seed)
    same(found_by(spark, rows), rows)


@pytest.mark.parametrize("chunk_rows", [1, 3])
def test_small_chunks(spark, monkeypatch, chunk_rows):
    """Every conversation is in many chunks, as a very long one is."""
    monkeypatch.setattr(cv, "CHUNK_ROWS", chunk_rows)
    rows = drawn(7 + chunk_rows, convs=12, most=25)
    same(found_by(spark, rows), rows)


def test_one_large_conversation(spark, monkeypatch):
    monkeypatch.setattr(cv, "CHUNK_ROWS", 16)
    draw = random.Random(4)
    rows = [(5, t, draw.choice(["user", "tool"]), draw.choice(["a.", "b", "c."]) * (t % 9), "", "", "") for t in range(600)]
    rows += drawn(1, convs=5)
    same(found_by(spark, rows), [r for r in rows])


def test_lost_and_empty(spark):
    lost = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, 0, "user", "x.", "", "", "") for c in lost]
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(found_by(spark, rows)) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in lost]
    assert found_by(spark, []) == []


def chunk(draw, n):
    return bytes(draw.choice([0, 1, 2, 3, 1, 2, 1 | cv.CUT_SHORT, 2 | cv.SEEN, 3 | cv.BLANK]) for _ in range(n))


def test_fix_up_is_a_run_from_the_true_costs():
    draw = random.Random(2)
    shorter = 0
    for _ in range(300):
        codes = chunk(draw, draw.randrange(40))
        end = tuple(draw.randrange(11) for _ in range(4))
        costs, rerun = cv.fix_up(codes, end, cv.backward(codes, cv.GUESS))
        assert costs == cv.backward(codes, end)
        shorter += rerun < len(codes)
    assert shorter > 100


def test_passes_do_not_grow_with_chunks(spark, monkeypatch):
    """Chunks that never forget their end's costs: all rows need another role, so pairs keep their phase."""
    monkeypatch.setattr(cv, "CHUNK_ROWS", 4)
    passes = []
    stitched = cv._stitched
    monkeypatch.setattr(cv, "_stitched", lambda tried: passes.append(1) or stitched(tried))
    rows = [(1, t, "tool", f"{t}.", "", "", "") for t in range(161)]
    same(found_by(spark, rows), rows)
    assert len(passes) <= 6
