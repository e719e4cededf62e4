import hashlib
import math
import statistics

import pytest
from tables import as_set, entities, messy, pairs

from twinfold.operators import profile, tokens
from twinfold.operators.sampling import grouped_split, keyed_sample
from twinfold.sources.entities import PAIR

ROWS = [(f"a{i % 37}", f"c{i}") for i in range(300)]


def digest(*ids):
    return hashlib.md5(",".join([*ids, "42"]).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 17, 299, 300, 1000])
def test_keyed_sample_is_order_by_limit(spark, n):
    expected = sorted(ROWS, key=lambda r: digest(*r))[:n]
    assert as_set(keyed_sample(pairs(spark, ROWS), n, PAIR)) == set(expected)


def test_keyed_sample_with_repeated_rows(spark):
    df = pairs(spark, ROWS[:20] * 3)
    assert [keyed_sample(df, n, PAIR).count() for n in (1, 2, 4, 59, 60)] == [1, 2, 4, 59, 60]


@pytest.mark.parametrize("fraction", [0.0, 0.2, 1.0])
def test_grouped_split(spark, fraction):
    train, valid = (as_set(x) for x in grouped_split(pairs(spark, ROWS), fraction))
    groups = {r[0] for r in valid}
    assert len(groups) == math.ceil(fraction * 37)
    assert train | valid == set(ROWS) and not groups & {r[0] for r in train}
    first = sorted({r[0] for r in ROWS}, key=digest)[: len(groups)]
    assert groups == set(first)


@pytest.fixture(scope="module")
def table(spark):
    return entities(spark, messy("a", 2))


def test_blank_counts_see_all_white_space(spark):
    df = entities(spark, [("1", None, "\t"), ("2", " ", "  　"), ("3", "x", "x"), ("4", "\n", "")])
    assert tuple(profile.blank_counts(df).first()) == (4, 3, 3)


def test_profile_and_duplicates(spark):
    df = entities(spark, [("1", "a", None), ("1", "a", None), ("1", "b", None), (None, "a", "x"), (None, "a", "y")])
    found = {r.column_name: r for r in profile.profile_table(df).collect()}
    assert found["entity_id"].missing == 2 and found["clean_address"].missing == 3
    assert found["clean_name"].row_count == 5 and found["clean_name"].column_count == 4
    assert tuple(profile.duplicate_counts(df).first()) == (1, 3)
    assert tuple(profile.duplicate_counts(df.limit(0)).first()) == (0, 0)


def test_value_frequencies(table):
    names = [r[1] for r in messy("a", 2) if r[1] and r[1].strip()]
    counts = {n: names.count(n) for n in names}
    assert {r.value: r["count"] for r in profile.value_frequencies(table, "clean_name").collect()} == counts
    top = profile.top_values(table, "clean_name", 3).collect()
    assert [(r.value, r["count"]) for r in top] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3]
    r = profile.frequency_summary(table, "clean_name").first()
    sizes = sorted(counts.values())
    assert r.unique_values == len(sizes) and (r["min"], r["max"]) == (sizes[0], sizes[-1])
    assert r.mean == pytest.approx(statistics.mean(sizes))
    assert r.std == pytest.approx(statistics.stdev(sizes))
    assert (r.q25, r.q50, r.q75) == pytest.approx(
        tuple(statistics.quantiles(sizes, n=4, method="inclusive"))
    )


def test_country_distribution(table):
    raw = {r[0]: r[1] for r in profile.country_distribution(table, "clean_country").collect()}
    clean = {r[0]: r[1] for r in profile.country_distribution(table, "clean_country", keep_null=False).collect()}
    assert raw[None] == 2 and None not in clean and sum(raw.values()) == len(messy("a", 2))


def test_token_reports(table):
    words = [
        (r[3], w) for r in messy("a", 2) if r[1] and r[1].strip(" ") for w in r[1].split(" ") if w.strip(" ")
    ]
    counts = {}
    for _, w in words:
        counts[w] = counts.get(w, 0) + 1
    frequency = tokens.token_frequency(table, "clean_name")
    assert {r.token: r.frequency for r in frequency.collect()} == counts
    buckets = tokens.frequency_buckets(frequency).orderBy("position").collect()
    assert len(buckets) == 10 and sum(r.tokens for r in buckets) == len(counts)
    assert buckets[0].tokens == sum(1 for n in counts.values() if n == 1)
    top = tokens.top_tokens(table, "clean_name", 2).collect()
    assert [r.token for r in top] == [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:2]]
    by_country = tokens.top_tokens_by_country(table, n=2).collect()
    assert {r.clean_country for r in by_country} == {"FR", "DE"} and len(by_country) == 4


def test_rare_tokens_count_records_not_occurrences(spark):
    df = entities(spark, [("1", "aaa aaa bbb", None), ("2", "aaa cc", None, None), ("3", "bbb aaa", None)])
    assert {r.token: r.frequency for r in tokens.rare_tokens(df, "clean_name", 2).collect()} == {"bbb": 2}
    assert {r.token: r.frequency for r in tokens.rare_tokens(df, "clean_name", 3).collect()} == {"aaa": 3, "bbb": 2}


def test_counts_beyond_a_long(spark, monkeypatch):
    """Billions of rows a key, as stand-in counts."""
    from pyspark.sql import functions as F
    from twinfold.operators import exact, metrics, profile, truth

    counts = spark.createDataFrame([("a", 4 * 10**9), ("b", 6 * 10**9)], "value string, count long")
    monkeypatch.setattr(profile, "value_frequencies", lambda df, column: counts)
    row = profile.frequency_summary(counts, "value").first()
    assert row["mean"] == 5e9 and row["std"] == pytest.approx(2**0.5 * 1e9)

    one = spark.createDataFrame([("e", "n", "a", "XX")], "entity_id string, clean_name string, clean_address string, clean_country string")
    monkeypatch.setattr(truth, "count_rows", lambda df: F.lit(4 * 10**9))
    real = truth.one_row
    monkeypatch.setattr(truth, "one_row", lambda **c: spark.range(1).select(*[v.alias(k) for k, v in c.items()]))
    known = spark.createDataFrame([("e", "f")], "source1_entity_id string, matched_entity_ids string")
    pairs = spark.createDataFrame([("e", "f")], "source1_entity_id string, candidate_entity_id string")
    assert truth.evaluate_blocking(pairs, known, one, one, one).first()["all_pairs"] == 32 * 10**18
    monkeypatch.setattr(truth, "one_row", real)

    ranked = spark.createDataFrame([(5 * 10**9, 5 * 10**9, 0, 5 * 10**9)], "pos long, tp long, fp long, positives long")
    assert metrics._average_precision(ranked).first()[0] == pytest.approx(1.0)
    both = spark.range(1).select(F.lit(4 * 10**9).alias("l"), F.lit(4 * 10**9).alias("r"))
    product = (F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")).cast("decimal(38,0)")
    assert both.agg(F.sum(product).alias("pairs")).first()["pairs"] == 16 * 10**18


def test_long_countries_stay_as_they_are(spark):
    from twinfold.operators import ngrams

    country = "land " * 20
    rows = spark.createDataFrame([("a", "abcdef", None, country), ("b", "abcdeg", None, country)], "entity_id string, clean_name string, clean_address string, clean_country string")
    found = ngrams.gram_frequency(rows)
    assert {r["clean_country"] for r in found.collect()} == {country}
    rare = ngrams.rarest_grams(rows, found)
    assert {(r["clean_country"], r["ngram"]) for r in rare.collect()} == {(country, "abcd"), (country, "bcde")}
    assert ngrams.ngram_block(rows.where("entity_id = 'a'"), rows).count() == 2
