"""Periodic runs against a plain search."""

import hashlib
import random

import numpy as np
import pytest

from twinfold.llm import periodic_runs as pr
from twinfold.llm.queries import op12_query, planted_periods


def plain_runs(words):
    """All runs by trying every period and every stretch."""
    n, found = len(words), {}
    for p in range(1, n // pr.PERIODS + 1):
        at = 0
        while at < n - p:
            end = at
            while end < n - p and words[end] == words[end + p]:
                end += 1
            length = end - at + p
            if end > at and length >= max(pr.LEAST, pr.PERIODS * p):
                found.setdefault((at, length), p)
            at = end + 1
    return sorted((s, m, p) for (s, m), p in found.items())


def as_rows(runs):
    order = sorted(zip(*(c.tolist() for c in runs)))
    return [(s, m, p) for s, m, p in order]


def draw_text(draw, most):
    n = draw.randrange(most)
    letters = draw.choice(["a", "ab", "abc", "abcdefghij"])
    words = [draw.choice(letters).encode() for _ in range(n)]
    while n and draw.random() < 0.6:
        at, p = draw.randrange(n), draw.randrange(1, 12)
        for i in range(at + p, min(n, at + p * draw.randrange(2, 9))):
            words[i] = words[i - p]
    return words


def test_cover():
    assert {(a - b) % pr.MODULUS for a in pr.COVER for b in pr.COVER} == set(range(pr.MODULUS))


@pytest.mark.parametrize("seed", range(6))
def test_extensions(seed):
    draw = random.Random(seed)
    n = draw.choice([5, 40, 200, 900])
    words = [draw.randrange(draw.choice([1, 2, 3])) for _ in range(n)]
    for at in range(n // 2, n):
        words[at] = words[at % 37] if seed % 2 else words[at]
    words = np.array([*words, 9])
    ask = pr.Extensions(words)
    i = np.array([draw.randrange(n) for _ in range(500)])
    j = np.array([draw.randrange(n) for _ in range(500)])
    i, j = i[i != j], j[i != j]
    for a, b, found in zip(i.tolist(), j.tolist(), ask(i, j).tolist()):
        k = 0
        while max(a, b) + k <= n and words[a + k] == words[b + k]:
            k += 1
        assert found == k


@pytest.mark.parametrize("together", [50, 200_000])
@pytest.mark.parametrize("at_once", [7, 1_000_000])
def test_search(together, at_once, monkeypatch):
    monkeypatch.setattr(pr, "TOGETHER", together)
    monkeypatch.setattr(pr, "AT_ONCE", at_once)
    draw = random.Random(together + at_once)
    texts = [draw_text(draw, draw.choice([2, 10, 60, 300])) for _ in range(150)]
    texts += [[], [b"x"], [b"x"] * 5, [b"x"] * 6, [b"x"] * 700, [b"a", b"b"] * 4, [b"a", b"b"] * 3]
    runs = pr.search(texts)
    for words, found in zip(texts, runs):
        assert as_rows(found) == plain_runs(words)
    assert sum(len(r[0]) for r in runs) > 50


DDL = "doc_id long, text string, words string, runs string, n_words string"


def cases():
    draw = random.Random(5)
    texts = [b" ".join(draw_text(draw, 80)).decode() for _ in range(60)]
    texts += [None, "", " \t\n\r\x0b\x0c", "word", "é　é " * 7, "\x85 " * 6, "A a " * 9, "x " * 3000]
    rows = [(i, t, "w", "r", "n") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "z z z z z z z", None, None, None), (None, None, None, None, None)]


def expected(doc_id, text):
    import zlib

    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = set()
    for s, m, p in runs:
        gone.update(range(s + p, s + m))
    best = None
    for s, m, p in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or m * best[2] > best[1] * p:
            best = (s, m, p)
    said = "".join(f"{s},{m},{p}\n" for s, m, p in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(said.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_query(spark):
    rows = cases()
    found = op12_query(spark.createDataFrame(rows, DDL)).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(expected(r[0], r[1])) for r in rows)
    assert sum(r.n_runs for r in found) > 20
    empty = op12_query(spark.createDataFrame([], DDL))
    assert empty.count() == 0 and [*empty.columns] == COLUMNS


def test_planted_periods(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = spark.range(200).selectExpr("id as doc_id", f"'{text}' as text")
    planted = {r.doc_id: r.text for r in planted_periods(rows).collect()}
    changed = [i for i, t in planted.items() if t != text]
    assert 5 < len(changed) < 40
    whole = {r.doc_id: r for r in op12_query(rows).collect()}
    for i in changed:
        assert tuple(whole[i]) == expected(i, text)
