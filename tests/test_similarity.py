import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import GOLDEN, S1, S2, S3, entities, golden_pairs, pairs

from twinfold.functions import lcs
from twinfold.operators.features import RAW_TEXT, pair_features
from twinfold.operators import similarity
from twinfold.operators.similarity import SCORES, fuzzy_features

NAMES = [f"{f}_{s}" for f in ("name", "address") for s in SCORES]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial(a, b):
    if not a or not b:
        return 0.0 if a or b else 100.0
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    windows = [b[i : i + n] for i in range(m - n + 1)]
    windows += [b[:k] for k in range(1, n)] + [b[m - k :] for k in range(1, n)]
    best = max(ratio(a, w) for w in windows)
    if n == m:
        best = max([best] + [ratio(b, w) for k in range(1, n) for w in (a[:k], a[n - k :])])
    return best


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = sorted(x & y)
    one, two = (" ".join(both + sorted(d)) for d in (x - y, y - x))
    scores = [ratio(one, two)]
    if both:
        scores += [ratio(" ".join(both), one), ratio(" ".join(both), two)]
    return max(scores)


def by_hand(a, b):
    sort = lambda t: " ".join(sorted(t.split()))
    return ratio(a, b), partial(a, b), ratio(sort(a), sort(b)), token_set(a, b)


text = st.text(alphabet="abcé😀 ", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(text, text), min_size=1, max_size=20))
def test_kernels_against_definition(rows):
    a, b = [r[0] for r in rows], [r[1] for r in rows]
    assert lcs.lcs_lengths(a, b).tolist() == [common(x, y) for x, y in rows]
    assert lcs.window_scores(a, b) == pytest.approx([partial(x, y) for x, y in rows])


def test_kernels_on_long_and_many_texts(monkeypatch):
    rng = random.Random(7)
    word = lambda k: "".join(rng.choice("abcdef gh") for _ in range(rng.randint(0, k)))
    a = [word(150) for _ in range(150)] + [word(700) for _ in range(4)]
    b = [word(150) for _ in range(150)] + [word(700) for _ in range(4)]
    expected = [common(x, y) for x, y in zip(a, b)]
    assert lcs.lcs_lengths(a, b).tolist() == expected
    monkeypatch.setattr(lcs, "LANES_PER_WORD", 1)  # everything through the arrays
    assert lcs.lcs_lengths(a, b).tolist() == expected
    monkeypatch.setattr(lcs, "MASK_WORDS", 100)  # batches halved for their alphabet
    assert lcs.lcs_lengths(a, b).tolist() == expected
    monkeypatch.setattr(lcs, "VECTOR_CHARS", 50)  # texts longer than a batch
    monkeypatch.setattr(lcs, "COMB_CHARS", 50)
    assert lcs.lcs_lengths(a, b).tolist() == expected
    few = slice(0, 40)
    expected = [partial(x, y) for x, y in zip(a[few], b[few])]
    assert lcs.window_scores(a[few], b[few]) == pytest.approx(expected)


def test_combing_moves_small_numbers(monkeypatch):
    """Strands and characters travel in 16 bits, and in 32 where they need them, with equal scores."""
    a, b = ["abba cd", "x\uffffy", "\ufffe z", "\U0001f600 ab"], ["bab cda bc", "xy\uffff\ufffe", "z \uffff \ufffe", "ab \U0001f600"]
    kinds, comb = [], lcs._comb
    monkeypatch.setattr(lcs, "_comb", lambda *texts: kinds.append(comb(*texts)) or kinds[-1])
    expected = [partial(x, y) for x, y in zip(a, b)]
    assert lcs.window_scores(a, b) == pytest.approx(expected)
    assert {k.dtype for k in kinds} == {np.dtype(np.uint16)}
    monkeypatch.setattr(lcs, "SHORT_STRANDS", 0)
    monkeypatch.setattr(lcs, "SHORT_CODES", 0)
    assert lcs.window_scores(a, b) == pytest.approx(expected)
    assert kinds[-1].dtype == np.uint32


def test_strands_at_the_limit_of_16_bits():
    """Texts whose strands just fit in 16 bits, and just do not."""
    for length in (lcs.SHORT_STRANDS - 2, lcs.SHORT_STRANDS - 1):
        text = "ab" * length
        found = lcs._comb(lcs._columns(["ca"], -1), lcs._columns([text[:length]], -2))
        assert found.dtype == (np.uint16 if length + 2 <= lcs.SHORT_STRANDS else np.uint32)
        assert lcs.window_scores(["ca"], [text[: length - 1] + "c"]) == pytest.approx([50.0 * 4 / 3])


def test_carries_go_through_many_words(monkeypatch):
    monkeypatch.setattr(lcs, "LANES_PER_WORD", 0)
    a = ["a" * 64 + "b" * 200 + "c", "b" * 300, "c" + "a" * 255]
    b = ["c" + "b" * 200 + "a" * 64, "ab" * 200, "a" * 300 + "c"]
    calls = []
    vector = lcs._vector_lcs
    monkeypatch.setattr(lcs, "_vector_lcs", lambda *t: calls.append(1) or vector(*t))
    assert lcs.lcs_lengths(a, b).tolist() == [common(x, y) for x, y in zip(a, b)] and calls


def test_dear_comparisons_come_first(spark):
    rows = spark.range(200).select(
        F.col("id").cast("string").cast("binary").alias("text_key"),
        F.when(F.col("id") == 7, 90_000).otherwise(1_000).cast("long").alias("cost"),
    )
    dealt = similarity.by_cost(rows, F.col("cost"), "text_key", task_cost=50_000)
    places = dealt.select("cost", F.spark_partition_id().alias("task")).collect()
    dear = {r["task"] for r in places if r["cost"] == 90_000}
    assert max(dear) < min(r["task"] for r in places if r["cost"] == 1_000)


def test_symmetry_and_range():
    rng = random.Random(3)
    words = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    a, b = words[:150], words[150:]
    one, two = lcs.window_scores(a, b), lcs.window_scores(b, a)
    assert one == pytest.approx(two)
    assert ((one >= 0) & (one <= 100)).all()
    assert (lcs.window_scores(a, a) == 100).all()
    assert np.array_equal(lcs.lcs_lengths(a, a), [len(t) for t in a])


@pytest.fixture(scope="module")
def features(spark):
    s1, c = entities(spark, S1), entities(spark, S2 + S3)
    return pair_features(pairs(spark, golden_pairs()), s1, c)


def test_golden_scores(features):
    scored = fuzzy_features(features)
    assert not set(RAW_TEXT) & set(scored.columns)
    rows = scored.collect()
    assert len(rows) == 14 and len(scored.columns) == 2 + 21
    for r in rows:
        expected = GOLDEN[f"{r.source1_entity_id[3:]} {r.candidate_entity_id}"]
        assert [r[n] for n in NAMES] == pytest.approx(expected, abs=5e-5)


def test_golden_deterministic_features(features):
    rows = {(r[0], r[1]): r for r in features.collect()}
    r = rows[("s1_001", "s3_001")]
    assert (r.name_exact, r.address_exact, r.country_exact) == (0, 1, 1)
    assert (r.name1_length, r.name2_length, r.name_length_diff) == (33, 9, 24)
    assert (r.address1_length, r.address2_length, r.address_length_diff) == (21, 21, 0)
    assert all(x[c] == 0 for x in rows.values() for c in x.asDict() if c.endswith("missing"))


def test_missing_and_odd_texts(spark):
    texts = [None, "", "  ", "a", " a b ", "b a", "a\tb", "é😀 a", "b a b", "A B"]
    s1 = entities(spark, [(f"a{i}", t, t, None) for i, t in enumerate(texts)])
    c = entities(spark, [(f"c{i}", t, t, "XX") for i, t in enumerate(texts)])
    wanted = pairs(spark, [(f"a{i}", f"c{j}") for i in range(10) for j in range(10)] + [("a0", "none")])
    table = pair_features(wanted, s1, c)
    rows = {(r[0], r[1]): r for r in table.collect()}
    assert len(rows) == 100
    assert rows[("a0", "c1")].name_exact == 1 and rows[("a0", "c0")].country_exact == 0
    assert rows[("a4", "c9")].name_exact == 1 and rows[("a0", "c3")].name1_missing == 1
    assert rows[("a2", "c2")].name1_length == 2 and rows[("a7", "c0")].name1_length == 4
    for r in fuzzy_features(table).collect():
        a, b = (texts[int(x[1:])] or "" for x in r[:2])
        assert [r[n] for n in NAMES[:4]] == pytest.approx(by_hand(a, b)), (a, b)


def test_repeated_entity_repeats_its_pairs(spark):
    s1 = entities(spark, [("a", "x", "y"), ("a", "z", "y")])
    c = entities(spark, [("c", "x", "y")])
    assert pair_features(pairs(spark, [("a", "c")]), s1, c).count() == 2


def test_equal_comparisons_are_made_once(spark, monkeypatch):
    """Pairs of the same two texts share a comparison, and equal texts need none."""
    seen = []
    by_cost = similarity.by_cost
    monkeypatch.setattr(similarity, "by_cost", lambda df, *a: seen.append(df.count()) or by_cost(df, *a))
    draw = random.Random(3)
    long = [" ".join(draw.choice(["ab", "b", "cde", "f"]) for _ in range(n)) for n in (40, 60, 200)]
    names = [*long, long[0], None, ""]
    s1 = entities(spark, [(f"a{i}", t, long[i % 2], None) for i, t in enumerate(names)])
    c = entities(spark, [(f"c{i}", t, long[0], None) for i, t in enumerate(names)])
    wanted = pairs(spark, [(f"a{i}", f"c{j}") for i in range(6) for j in range(6)])
    rows = fuzzy_features(pair_features(wanted, s1, c)).collect()
    assert len(rows) == 36
    for r in rows:
        a, b = (names[int(x[1:])] or "" for x in r[:2])
        assert [r[n] for n in NAMES[:4]] == pytest.approx(by_hand(a, b)), (a, b)
        assert [r[n] for n in NAMES[4:]] == pytest.approx(by_hand(long[int(r[0][1:]) % 2], long[0]))
    # Different names: three long ones and the empty one, both ways round; the one address pair is among them.
    assert seen == [12]


def test_comparisons_are_dealt_by_cost(spark):
    costs = [1] * 5000 + [900] * 50 + [40_000] * 6
    rows = spark.createDataFrame(enumerate(costs), "text_key long, cost long")
    dealt = similarity.by_cost(rows, F.col("cost"), "text_key", task_cost=50_000)
    tasks = [sum(r["cost"] for r in task) for task in dealt.rdd.glom().collect()]
    assert max(tasks) <= 3 * 40_000 and sum(tasks) == sum(costs) and len(tasks) >= 6
    assert similarity.by_cost(rows.limit(0), F.col("cost"), "text_key").count() == 0
