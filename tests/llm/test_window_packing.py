"""Packing into windows: an exact round trip, and the plan by itself."""

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twinfold.llm import window_packing as wp
from twinfold.llm.queries import BYTE_TOKENIZER

DDL = "doc_id long, text string, length string, task string, wide string"


@cache
def tokenizer():
    return Tokenizer.from_file(BYTE_TOKENIZER)


def plain_ids(text):
    plain = tokenizer()
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@pytest.fixture(scope="module")
def encoder():
    return wp.WordEncoder(BYTE_TOKENIZER), tokenizer()


ODD = ["word", ".", ",\"", "'", "\n\n", "\0", " a", " b.", " ", "  ", "\n", "\t", "\r\n", "\xa0", "\u3000", "\x1c", "\x85", "a", "B", "é", "7", "it's", "'ll", "...", "<|endoftext|>", "<|", "日本", "🙂", "x" * 70]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=20).map("".join))
def test_words_are_encoded_as_whole_texts_are(encoder, text):
    ours, plain = encoder
    text = text.encode("utf-8", "ignore").decode()
    ids = plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ours([text])[0], "<u4").tolist() == ids


def test_known_words_are_bounded(encoder, monkeypatch):
    monkeypatch.setattr(wp, "CACHED_BYTES", 1000)
    ours = wp.WordEncoder(BYTE_TOKENIZER)
    texts = [f"a{i} b{i % 7} {'z' * 80}" for i in range(200)]
    assert [len(x) for x in ours(texts)] == [len(x) for x in encoder[0](texts)]
    assert ours.held <= 1000
    monkeypatch.setattr(wp, "TOGETHER", 50)
    assert [*ours.each(texts)] == encoder[0](texts) and [*ours.each([])] == []


def test_words_are_looked_up_once_a_portion(encoder):
    class Counted(dict):
        looked_up = 0

        def get(self, *key):
            Counted.looked_up += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counted.looked_up += 1
            return super().__getitem__(key)

    ours, texts = wp.WordEncoder(BYTE_TOKENIZER), ["one two, three\nfour " + "five six " * 50 + "."] * 40
    first = ours(texts)
    ours.known = Counted(ours.known)
    assert ours(texts) == first == encoder[0](texts)
    assert 0 < Counted.looked_up < 50


def test_white_space_that_splits_no_words():
    """All that Python or the tokenizer takes for white space; slices of a column."""
    odd = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"]
    kept = pa.array(["a b", "c\n\nd e", " f\n", *(f"x{c}y" for c in odd), "", "g h"])
    uneven = pc.match_substring_regex(kept, wp.UNEVEN).to_pylist()
    assert uneven == [False, False, True, *[True] * len(odd), False, False]
    ours = wp.WordEncoder(BYTE_TOKENIZER)
    for a in range(5):
        found = [np.frombuffer(x, "<u4").tolist() for x in ours(kept.slice(a, len(kept) - a))]
        assert found == [plain_ids(t).tolist()[:-1] for t in kept.to_pylist()[a:]]


def placed(plan, counts):
    """Tokens of every window as (offset, tokens), all tails put in."""
    places, windows = plan.places(), {}
    for length, n in counts.items():
        for rank in range(n):
            at = 0
            for start, size, window, offset in plan.of(places, length, rank):
                assert start == at and size > 0
                at += size
                windows.setdefault(window, []).append((offset, size))
            assert at == length
    return windows


def check(windows, window):
    for parts in windows.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == window or at & (at - 1) == 0


@pytest.mark.parametrize("window", [8, 64, 1024])
@pytest.mark.parametrize("seed", range(4))
def test_plan(window, seed):
    draw = random.Random(seed)
    drawn = [min(window - 1, 1 + int(draw.expovariate(4 / window))) for _ in range(draw.choice([1, 7, 900]))]
    counts = Counter(drawn)
    counts[draw.randrange(1, window)] += 300 * (seed % 2)  # a hot length
    plan = wp.Plan(counts, window)
    windows = placed(plan, counts)
    check(windows, window)
    total = sum(x * n for x, n in counts.items())
    assert sorted(windows) == list(range(plan.windows))
    assert plan.windows <= total // window + window.bit_length()


def test_most_tails_stay_whole():
    draw = random.Random(3)
    drawn = (1 + int(draw.lognormvariate(5, 1)) for _ in range(50_000))
    counts = Counter(x for x in drawn if x < 1024)
    plan = wp.Plan(counts, 1024)
    streamed = sum(n for _, _, n, _ in plan.stream)
    assert streamed < 0.01 * sum(counts.values())
    assert placed(plan, counts).keys() == set(range(plan.windows))


def test_fit_of_counts():
    """A histogram made of combinations is met."""
    lengths = np.arange(1, 64)
    shapes = wp.combinations(lengths, 64)
    assert {tuple(sorted(lengths[s[s >= 0]])) for s in shapes} == {
        t for a in range(1, 64) for b in range(a, 64) for t in [(a, b), (a, b, 64 - a - b)]
        if sum(t) == 64 and t[-1] >= b and min(t) > 0
    }
    draw = random.Random(1)
    counts = np.zeros(63, np.int64)
    for _ in range(40):
        s = shapes[draw.randrange(len(shapes))]
        np.add.at(counts, s[s >= 0], 1000)
    x = wp.fit_counts(shapes, counts.astype(float))
    assert (x >= 0).all()
    met = sum(np.bincount(shapes[shapes[:, c] >= 0, c], x[shapes[:, c] >= 0], 63) for c in range(3))
    assert np.abs(met - counts).sum() < 0.05 * counts.sum()
    used = wp.repeat_counts(shapes, x, counts)
    taken = sum(np.bincount(shapes[shapes[:, c] >= 0, c], used[shapes[:, c] >= 0], 63) for c in range(3))
    assert (taken <= counts).all() and taken.sum() > 0.8 * counts.sum()


def corpus():
    draw = random.Random(8)
    rows = []
    for i in range(250):
        words = [draw.choice(["the", "license", "é", "of", "x1", "\n", "zebra's"]) for _ in range(draw.randrange(900))]
        rows.append((i, " ".join(words), "l", "t", "w"))
    same = "the same text " * 100
    rows += [(1000 + i, same, "l", "t", "w") for i in range(120)]
    rows += [(2000, None, "l", "t", "w"), (2001, "", "l", "t", "w"), (None, "no id", "l", "t", "w")]
    rows += [(2002, "word " * 30_000, "l", "t", "w"), rows[0], (2003, "<|endoftext|> a", "l", "t", "w")]
    return rows


@pytest.mark.parametrize("with_ids", [False, True])
def test_round_trip(spark, with_ids):
    rows = corpus()
    packed = wp.pack_windows(spark.createDataFrame(rows, DDL), BYTE_TOKENIZER, with_ids=with_ids)
    assert packed.columns[:7] == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    found = packed.collect()
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    check(sequences, 1024)
    want = Counter((i, len(plain_ids(t))) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.doc_tokens) for r in found if r.start == 0) == want
    ids = {i: plain_ids(t) for i, t, *_ in rows}
    pieces = Counter()
    for r in found:
        part = ids[r.doc_id][r.start : r.start + r.length].tobytes()
        assert r.length * 4 == len(part) and r.ids_crc32 == zlib.crc32(part)
        assert not with_ids or bytes(r.ids) == part
        pieces[r.doc_id] += r.length
    assert pieces == Counter({i: sum(n * k for (j, n), k in want.items() if j == i) for i in ids})


def test_empty_table(spark):
    packed = wp.pack_windows(spark.createDataFrame([], DDL), BYTE_TOKENIZER)
    assert packed.count() == 0


def test_wide_numbers():
    for numbers in ([0, 5, 65535], [65536, 1], []):
        ids = np.array(numbers, "<u4").tobytes()
        assert wp.widened(*wp.narrow(ids)) == ids
