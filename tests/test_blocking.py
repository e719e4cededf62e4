from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from tables import S1, S2, S3, as_set, entities, messy, short

from twinfold.operators import exact, ngrams, postings, skew, tokens
from twinfold.operators.pairs import block_coverage, new_pairs, union_pairs


@pytest.fixture(scope="module")
def small(spark):
    return entities(spark, S1), entities(spark, S2 + S3)


@pytest.fixture(scope="module")
def rough(spark):
    rows = messy("a"), messy("c", 2)
    return *rows, entities(spark, rows[0]), entities(spark, rows[1])


def blank(text):
    return text is None or text.strip(" ") == ""


def exact_by_hand(s1, c, at, cap=None):
    size = Counter((r[3], r[at]) for r in c if r[3] is not None and not blank(r[at]))
    return {
        (a[0], b[0])
        for a in s1
        for b in c
        if a[3] is not None and a[3] == b[3] and not blank(a[at]) and a[at] == b[at]
        and (cap is None or size[(b[3], b[at])] <= cap)
    }


def tokens_by_hand(s1, c, at, cap, least=3):
    def split(r):
        return {t for t in r[at].split(" ") if len(t) >= least} if not blank(r[at]) else set()

    often = Counter(t for r in c for t in split(r))
    return {
        (a[0], b[0])
        for a in s1
        for b in c
        if a[3] is not None and a[3] == b[3]
        and any(often[t] <= cap for t in split(a) & split(b))
    }


def ngrams_by_hand(s1, c, low, high, most, k, n=4):
    def grams(r):
        if blank(r[1]) or blank(r[3]):
            return []
        return [r[1][i : i + n].lower() for i in range(len(r[1]) - n + 1)]

    often = Counter((r[3], g) for r in c for g in grams(r))
    useful = {key: f for key, f in often.items() if low <= f <= high}
    listed = defaultdict(set)
    for r in c:
        for g in grams(r):
            listed[(r[3], g)].add(r[0])
    own = defaultdict(set)
    for r in s1:
        own[r[0]] |= {(r[3], g) for g in grams(r) if (r[3], g) in useful}
    found = set()
    for one, keys in own.items():
        chosen = sorted(keys, key=lambda x: (useful[x], x[1], x[0]))[:most]
        score = defaultdict(lambda: [0, Fraction(0)])
        for key in chosen:
            for other in listed[key]:
                score[other][0] += 1
                score[other][1] += Fraction(1, useful[key])
        best = sorted(score, key=lambda o: (-score[o][0], -score[o][1], o))[:k]
        found |= {(one, o) for o in best}
    return found


def test_exact_golden(small):
    assert short(as_set(exact.exact_block(*small))) == {
        "002 s2_002", "004 s2_004", "005 s2_005", "006 s2_006",
    }


def test_tokens_golden(small):
    s1, c = small
    cap50 = short(as_set(tokens.token_block(s1, c, "clean_name")))
    assert cap50 == {
        "001 s2_001", "002 s2_002", "002 s2_007", "003 s2_003",
        "004 s2_004", "005 s2_005", "006 s2_006",
    }
    cap1 = tokens.token_block(s1, c, "clean_name", max_freq=1)
    assert short(as_set(cap1)) == cap50 - {"002 s2_007"}
    assert tokens.token_block(s1, c, "clean_address").count() == 16
    address1 = tokens.token_block(s1, c, "clean_address", max_freq=1)
    assert short(as_set(address1)) == {
        "001 s2_001", "001 s2_004", "002 s2_002", "003 s2_003",
        "004 s2_004", "005 s2_005", "006 s2_006",
    }
    assert len(as_set(union_pairs(exact.exact_block(s1, c), cap1, address1))) == 7


def test_ngrams_golden(small):
    s1, c = small
    rows = ngrams.gram_pair_scores(s1, c).collect()
    found = {(r[0][3:] + " " + r[1]): (r.shared_ngrams, round(r.rarity_score, 9)) for r in rows}
    assert found == {
        "001 s2_001": (6, 3.0),
        "001 s3_001": (6, 3.0),
        "002 s2_002": (19, 9.333333333),
        "002 s3_002": (14, 7.0),
        "002 s2_007": (5, 2.333333333),
    }
    assert short(as_set(ngrams.ngram_block(s1, c))) == set(found)
    assert short(as_set(ngrams.ngram_block(s1, c, top_k=1))) == {"001 s2_001", "002 s2_002"}


@pytest.mark.parametrize("at,column", [(1, "clean_name"), (2, "clean_address")])
def test_exact_against_hand(rough, at, column):
    rows1, rows2, s1, c = rough
    rows = exact.exact_rows(s1, c, column).collect()
    assert {tuple(r) for r in rows} == exact_by_hand(rows1, rows2, at)


@pytest.mark.parametrize("cap", [1, 2, 4])
def test_capped_against_hand(rough, cap):
    rows1, rows2, s1, c = rough
    expected = exact_by_hand(rows1, rows2, 1, cap) | exact_by_hand(rows1, rows2, 2, cap)
    assert as_set(exact.capped_block(s1, c, cap, cap)) == expected
    assert expected <= as_set(exact.exact_block(s1, c))


@pytest.mark.parametrize("at,column,cap", [(1, "clean_name", 3), (1, "clean_name", 50), (2, "clean_address", 4)])
def test_tokens_against_hand(rough, at, column, cap):
    rows1, rows2, s1, c = rough
    assert as_set(tokens.token_block(s1, c, column, cap)) == tokens_by_hand(rows1, rows2, at, cap)


@pytest.mark.parametrize("low,high,most,k", [(2, 500, 20, 20), (1, 6, 5, 2), (2, 4, 20, 3)])
def test_ngrams_against_hand(rough, low, high, most, k):
    rows1, rows2, s1, c = rough
    found = ngrams.ngram_block(
        s1, c, min_freq=low, max_freq=high, max_grams=most, top_k=k
    )
    assert as_set(found) == ngrams_by_hand(rows1, rows2, low, high, most, k)


def test_hot_keys_are_dealt_over_cells(spark, monkeypatch):
    """A third and more of both sides under one key, in cells of two rows."""
    rows1 = [(f"a{i}", "hot" if i % 2 else f"n{i}", None, "XX") for i in range(30)]
    rows2 = [(f"c{i}", "hot" if i % 3 else f"n{i}", None, "XX") for i in range(40)]
    s1, c = entities(spark, rows1), entities(spark, rows2)
    monkeypatch.setattr(exact, "CELL_ROWS", 2)
    left = exact.keyed(s1, "clean_name")
    hot = skew.hot_keys_of_both(left, exact.keyed(c, "clean_name"), exact.KEY, 2)
    assert [(r.left_cells, r.right_cells) for r in hot.cells.collect()] == [(8, 13)]
    assert as_set(exact.exact_rows(s1, c, "clean_name")) == exact_by_hand(rows1, rows2, 1)
    total = exact.exact_pair_total(s1, c, "clean_name").first()["pairs"]
    assert total == len(exact_by_hand(rows1, rows2, 1))


def test_pairs_of_hot_keys_reach_many_tasks(spark, monkeypatch):
    """Adaptive execution may not merge cells, however few bytes they are."""
    monkeypatch.setattr(exact, "CELL_ROWS", 20)
    monkeypatch.setattr(skew, "TASK_PAIRS", 10_000)
    rows1 = [(f"a{i}", f"hot{i % 3}", None, "XX") for i in range(1200)]
    rows2 = [(f"c{i}", f"hot{i % 3}", None, "XX") for i in range(1200)]
    s1, c = entities(spark, rows1), entities(spark, rows2)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    pairs = exact.exact_rows(s1, c, "clean_name")
    per_task = pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()
    total = sum(r["count"] for r in per_task)
    assert total == 3 * 400 * 400
    assert len(per_task) > 20 and max(r["count"] for r in per_task) < total / 8


def test_every_hot_key_is_dealt(spark):
    """However many there are, and whichever side makes them hot."""
    left = spark.range(3000).selectExpr("id % 1000 AS k", "id AS entity_id")
    right = spark.range(9000).selectExpr("id % 1000 AS k", "id AS other_id")
    hot = skew.hot_keys_of_both(left, right, ["k"], 2)
    assert hot.cells.count() == 1000
    assert {(r.left_cells, r.right_cells) for r in hot.cells.collect()} == {(2, 5)}
    joined = skew.spread_join(left, right, ["k"], hot, "entity_id", "other_id")
    assert joined.count() == 27_000 == joined.distinct().count()


def test_hot_reference_keys_and_bounded_lists(spark, monkeypatch):
    """Salting and the common-key list change nothing, also when they overflow."""
    rows1, rows2 = messy("a", 3), messy("c", 2)
    s1, c = entities(spark, rows1), entities(spark, rows2)
    real = skew.hot_keys
    for module in (exact, tokens, ngrams):
        monkeypatch.setattr(module, "hot_keys", lambda left, keys: real(left, keys, 2))
    monkeypatch.setattr(postings, "MAX_COMMON", 2)
    assert as_set(tokens.token_block(s1, c, "clean_name", 3)) == tokens_by_hand(rows1, rows2, 1, 3)
    assert as_set(exact.capped_block(s1, c, 3, 3)) == exact_by_hand(rows1, rows2, 1, 3) | exact_by_hand(rows1, rows2, 2, 3)
    assert as_set(ngrams.ngram_block(s1, c, max_freq=6)) == ngrams_by_hand(rows1, rows2, 2, 6, 20, 20)


def test_pair_sets(small):
    s1, c = small
    base, more = exact.exact_block(s1, c), ngrams.ngram_block(s1, c)
    fresh = as_set(new_pairs(more, base))
    assert fresh == as_set(more) - as_set(base)
    assert as_set(union_pairs(base, more)) == as_set(base) | as_set(more)
    assert tuple(block_coverage(base).first()) == (4, 4)
    assert tuple(block_coverage(base.limit(0)).first()) == (0, 0)


def test_id_codes_sort_like_ids(rough):
    _, _, s1, c = rough
    rows = ngrams.id_codes(s1, c).collect()
    assert [r.entity_id for r in sorted(rows, key=lambda r: r.code)] == sorted(r.entity_id for r in rows)
    assert len({r.code for r in rows}) == len({r.entity_id for r in rows}) == len(rows)
