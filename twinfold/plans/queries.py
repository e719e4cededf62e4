"""Queries over the test tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinfold.operators import exact, matcher, metrics, ngrams, outputs, profile, tokens, truth
from twinfold.operators.counts import count_rows, one_row
from twinfold.operators.features import RAW_TEXT, pair_features
from twinfold.operators.pairs import block_coverage, new_pairs
from twinfold.operators.sampling import grouped_split, keyed_sample
from twinfold.operators.similarity import fuzzy_features, text_scores
from twinfold.plans.cards import ALSO_DIRTY, Cards, dirty_cards, line_cards, part_cards, truth_lists
from twinfold.plans.jobs import save_matcher, score_job
from twinfold.session import shared_folder, stage, together
from twinfold.sources.entities import (
    ENTITY,
    PAIR,
    candidates_of,
    read_entities,
    read_id_lists,
    text_schema,
)
from twinfold.sources.sinks import (
    write_parquet,
    write_positive_pairs,
    write_record,
    write_report,
    write_tsv,
)

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Cards], DataFrame]) -> Callable[[Cards], DataFrame]:
    """Registers a query over the line cards, and over the dirty ones if it is listed there."""
    name = build.__name__
    REGISTRY[name] = lambda spark, sf_dir: build(Cards(spark, sf_dir, line_cards))
    if name in ALSO_DIRTY:
        REGISTRY[f"{name}_dirty"] = lambda spark, sf_dir: build(Cards(spark, sf_dir, dirty_cards))
    return build


def part_query(build: Callable[[Cards], DataFrame]) -> Callable[[Cards], DataFrame]:
    """Registers a query over the part cards."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Cards(spark, sf_dir, part_cards))

    REGISTRY[build.__name__] = run
    return build


def _truth(c: Cards) -> DataFrame:
    return truth_lists(c.all)


# --- tables and profiles -----------------------------------------------------


@query
def entity_view(c: Cards) -> DataFrame:
    return c.all


def part_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_cards(spark, sf_dir)


REGISTRY["part_view"] = part_view


@query
def candidate_table(c: Cards) -> DataFrame:
    return candidates_of(c.s2, c.s3)


@query
def profile_blanks(c: Cards) -> DataFrame:
    return profile.blank_counts(c.s1)


@query
def profile_columns(c: Cards) -> DataFrame:
    return profile.profile_table(c.candidates)


@query
def profile_duplicates(c: Cards) -> DataFrame:
    return profile.duplicate_counts(c.candidates.select("clean_name", "clean_country"), "clean_name")


@query
def profile_columns_all(c: Cards) -> DataFrame:
    tables = zip(("S1", "S2", "S3"), (c.s1, c.s2, c.s3))
    one, two, three = [profile.profile_table(t).withColumn("origin", F.lit(o)) for o, t in tables]
    return one.unionByName(two).unionByName(three)


@query
def profile_duplicates_planted(c: Cards) -> DataFrame:
    """All records; those whose id ends in 7 are repeated, and of those whose id ends in 3 there is
    a second version in another country."""
    cards = c.all.drop("origin")
    again = cards.where(F.col("entity_id").endswith("7"))
    other = cards.where(F.col("entity_id").endswith("3")).withColumn("country", F.lit("elsewhere"))
    return profile.duplicate_counts(cards.unionByName(again).unionByName(other))


@query
def name_top20(c: Cards) -> DataFrame:
    return profile.top_values(c.candidates, "clean_name")


@query
def address_top20(c: Cards) -> DataFrame:
    return profile.top_values(c.candidates, "clean_address")


@query
def name_freq_summary(c: Cards) -> DataFrame:
    return _rounded(profile.frequency_summary(c.candidates, "clean_name"), "mean", "std")


@query
def address_freq_summary(c: Cards) -> DataFrame:
    return _rounded(profile.frequency_summary(c.s1, "clean_address"), "mean", "std")


@query
def country_counts(c: Cards) -> DataFrame:
    return profile.country_distribution(c.candidates, "country")


@query
def clean_country_counts(c: Cards) -> DataFrame:
    return profile.country_distribution(c.s1, "clean_country", keep_null=False)


@query
def first_rows(c: Cards) -> DataFrame:
    return c.s1.orderBy("entity_id").limit(5)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- tokens ------------------------------------------------------------------


@query
def token_top30(c: Cards) -> DataFrame:
    return tokens.top_tokens(c.candidates, "clean_name")


@query
def address_token_top30(c: Cards) -> DataFrame:
    return tokens.top_tokens(c.candidates, "clean_address")


@query
def token_buckets(c: Cards) -> DataFrame:
    return tokens.frequency_buckets(tokens.token_frequency(c.candidates, "clean_name"))


@query
def address_token_buckets(c: Cards) -> DataFrame:
    return tokens.frequency_buckets(tokens.token_frequency(c.candidates, "clean_address"))


@query
def token_country_top15(c: Cards) -> DataFrame:
    return tokens.top_tokens_by_country(c.candidates)


@query
def rare_tokens_name(c: Cards) -> DataFrame:
    return tokens.rare_tokens(c.candidates, "clean_name")


@query
def rare_tokens_address(c: Cards) -> DataFrame:
    return tokens.rare_tokens(c.candidates, "clean_address")


@query
def name_token_pairs_cap10(c: Cards) -> DataFrame:
    return tokens.token_block(c.s1, c.candidates, "clean_name", max_freq=10)


# --- exact blocks ------------------------------------------------------------


@query
def exact_name_pairs(c: Cards) -> DataFrame:
    return exact.exact_rows(c.s1, c.candidates, "clean_name")


@query
def exact_address_pairs(c: Cards) -> DataFrame:
    return exact.exact_rows(c.s1, c.candidates, "clean_address")


@query
def exact_name_pair_total(c: Cards) -> DataFrame:
    return exact.exact_pair_total(c.s1, c.candidates, "clean_name")


@query
def block_exact(c: Cards) -> DataFrame:
    return exact.exact_block(c.s1, c.candidates)


@query
def block_capped(c: Cards) -> DataFrame:
    return exact.capped_block(c.s1, c.candidates)


@query
def block_capped_low(c: Cards) -> DataFrame:
    return exact.capped_block(c.s1, c.candidates, name_cap=2, address_cap=2)


@query
def block_capped_coverage(c: Cards) -> DataFrame:
    return block_coverage(exact.capped_block(c.s1, c.candidates))


# --- token and n-gram blocks -------------------------------------------------


NAME, ADDRESS = "clean_name", "clean_address"


@query
def block_name_tokens(c: Cards) -> DataFrame:
    return tokens.combined_block(c.s1, c.candidates, [NAME])


@query
def block_address_tokens(c: Cards) -> DataFrame:
    return tokens.combined_block(c.s1, c.candidates, [ADDRESS])


@query
def block_combined(c: Cards) -> DataFrame:
    return tokens.combined_block(c.s1, c.candidates, [NAME, ADDRESS])


@query
def ngram_frequency(c: Cards) -> DataFrame:
    return ngrams.gram_frequency(c.candidates)


@query
def ngram_useful(c: Cards) -> DataFrame:
    return ngrams.useful_grams(ngrams.gram_frequency(c.candidates))


@query
def ngram_s1_top(c: Cards) -> DataFrame:
    return ngrams.rarest_grams(c.s1, stage(ngrams.gram_frequency(c.candidates)))


@query
def ngram_pair_scores(c: Cards) -> DataFrame:
    return _rounded(ngrams.gram_pair_scores(c.s1, c.candidates), "rarity_score")


@query
def ngram_topk(c: Cards) -> DataFrame:
    return ngrams.ngram_block(c.s1, c.candidates)


@query
def ngram_topk_low(c: Cards) -> DataFrame:
    return ngrams.ngram_block(c.s1, c.candidates, max_freq=100, top_k=3)


@query
def ngram_new_pairs(c: Cards) -> DataFrame:
    found = stage(ngrams.ngram_block(c.s1, c.candidates))
    return new_pairs(found, exact.exact_block(c.s1, c.candidates, among=found))


@query
def block_ngram(c: Cards) -> DataFrame:
    ngram = lambda: ngrams.ngram_block(c.s1, c.candidates)
    return tokens.combined_block(c.s1, c.candidates, [NAME, ADDRESS], more=ngram)


# --- truth -------------------------------------------------------------------


@query
def truth_pairs(c: Cards) -> DataFrame:
    return truth.explode_id_list(_truth(c))


@query
def blocking_quality(c: Cards) -> DataFrame:
    pairs = stage(exact.capped_block(c.s1, c.candidates, name_cap=2, address_cap=2))
    quality = truth.evaluate_blocking(pairs, stage(_truth(c)), c.s1, c.s2, c.s3)
    return _rounded(quality, "recall", "candidate_ratio", "reduction")


@query
def missed_pairs(c: Cards) -> DataFrame:
    pairs = exact.capped_block(c.s1, c.candidates, name_cap=2, address_cap=2)
    return truth.missed_pairs(pairs, _truth(c))


@query
def missed_details(c: Cards) -> DataFrame:
    pairs = exact.capped_block(c.s1, c.candidates, name_cap=2, address_cap=2)
    return truth.missed_details(pairs, _truth(c), c.s1, c.candidates)


@query
def missed_details_sample(c: Cards) -> DataFrame:
    pairs = stage(exact.capped_block(c.s1, c.candidates, name_cap=2, address_cap=2))
    return truth.missed_details(pairs, stage(_truth(c)), c.s1, c.candidates, sample=7)


# --- features and similarity -------------------------------------------------


def _line_features(c: Cards) -> DataFrame:
    return pair_features(exact.capped_block(c.s1, c.candidates), c.s1, c.candidates)


@query
def pair_features_lines(c: Cards) -> DataFrame:
    return _line_features(c)


def _fuzzy_features(c: Cards) -> DataFrame:
    return c.derived("fuzzy", lambda: fuzzy_features(_line_features(c)))


@query
def fuzzy_features_lines(c: Cards) -> DataFrame:
    return _fuzzy_features(c)


def fuzzy_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items, which are long texts, each against the next that begins with the same letter."""
    following = Window.partitionBy(F.substring("text", 1, 1)).orderBy("item_id")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    pairs = items.select("item_id", F.col("text").alias("a"), F.lead("text").over(following).alias("b"))
    keyed = stage(pairs.where("b is not null").withColumn("text_key", F.col("item_id").cast("string").cast("binary")))
    found = text_scores(keyed.select("text_key", "a", "b")).select("text_key", "found.*")
    scores = found.select("text_key", *(F.round(c, 6).alias(c) for c in ("ratio", "token_sort_ratio")))
    return keyed.join(scores, "text_key").select("item_id", "ratio", "token_sort_ratio")


REGISTRY["fuzzy_neighbours"] = fuzzy_neighbours


def _part_features(c: Cards) -> DataFrame:
    return pair_features(ngrams.ngram_block(c.s1, c.candidates), c.s1, c.candidates)


@part_query
def pair_features_parts(c: Cards) -> DataFrame:
    return _part_features(c)


@part_query
def fuzzy_features_parts(c: Cards) -> DataFrame:
    scored = fuzzy_features(_part_features(c))
    return _rounded(scored, *[n for n in scored.columns if n.endswith("ratio")])


# --- training, metrics, scoring ----------------------------------------------


def _numeric_features(c: Cards) -> DataFrame:
    return _line_features(c).drop(*RAW_TEXT)


@query
def train_positives(c: Cards) -> DataFrame:
    return matcher.training_positives(_numeric_features(c), _truth(c))


@query
def train_negatives(c: Cards) -> DataFrame:
    return matcher.training_negatives(_numeric_features(c), _truth(c))


@query
def labelled_pairs(c: Cards) -> DataFrame:
    pairs = exact.capped_block(c.s1, c.candidates)
    return matcher.label_pairs(pairs, _truth(c))


@query
def train_sample(c: Cards) -> DataFrame:
    return matcher.training_sample(
        stage(_numeric_features(c)), stage(_truth(c)), max_negatives=1000, negative_ratio=3
    )


@query
def sampled_pairs(c: Cards) -> DataFrame:
    return keyed_sample(stage(exact.capped_block(c.s1, c.candidates)), 500, PAIR)


@query
def split_groups(c: Cards) -> DataFrame:
    train, valid = grouped_split(stage(exact.capped_block(c.s1, c.candidates)))
    return train.withColumn("held_out", F.lit(0)).unionByName(
        valid.withColumn("held_out", F.lit(1))
    )


def _closeness(one: str, two: str):
    longer = F.greatest(one, two)
    part = F.expr(f"10000 * least({one}, {two}) div greatest({one}, {two})")
    return F.when(longer == 0, F.lit(0)).otherwise(part)


def scored_lines(c: Cards) -> DataFrame:
    """Labelled pairs with a score made of equal texts and similar lengths."""
    return c.derived("scored", lambda: _score_lines(c))


def _score_lines(c: Cards) -> DataFrame:
    pairs = tokens.token_block(c.s1, c.candidates, "clean_name")
    features = pair_features(pairs, c.s1, c.candidates)
    score = (
        _closeness("name1_length", "name2_length")
        + _closeness("address1_length", "address2_length")
        + 10000 * (F.col("name_exact") + F.col("address_exact"))
    )
    points = features.select(*PAIR, score.cast("long").alias("points"))
    return matcher.label_pairs(points, _truth(c)).select(
        *PAIR, "label", (F.expr("points div 4") / F.lit(10000.0)).alias("match_probability")
    )


@query
def threshold_sweep(c: Cards) -> DataFrame:
    return _rounded(metrics.threshold_sweep(scored_lines(c)), "threshold", "precision", "recall", "f0_5")


@query
def best_threshold(c: Cards) -> DataFrame:
    best = metrics.best_threshold(metrics.threshold_sweep(scored_lines(c)))
    return _rounded(best, "threshold", "precision", "recall", "f0_5")


@query
def confusion_counts(c: Cards) -> DataFrame:
    said = (F.col("match_probability") >= 0.9).cast("int")
    counts = metrics.confusion(scored_lines(c).withColumn("prediction", said))
    return _rounded(counts, "precision", "recall", "f0_5")


@query
def roc_auc(c: Cards) -> DataFrame:
    return _rounded(metrics.roc_auc(scored_lines(c)), "roc_auc")


@query
def average_precision(c: Cards) -> DataFrame:
    return _rounded(metrics.average_precision(scored_lines(c)), "average_precision")


_matchers: dict[tuple[str, str], matcher.Matcher] = {}


def _training_features(c: Cards, **limits: int) -> DataFrame:
    """``training_sample`` of all pairs' features, which are only made of the pairs in it.

    Pairs are sampled by their ids, so features do not decide which.  A repeated id repeats the rows
    of its pairs, which are then counted with their features.
    """
    if exact.has_repeated_ids(c.s1, c.candidates):
        return matcher.training_sample(_fuzzy_features(c), stage(_truth(c)), **limits)
    pairs = stage(exact.capped_block(c.s1, c.candidates))
    sample = matcher.training_sample(pairs, stage(_truth(c)), **limits)
    found = pair_features(sample.select(*PAIR), c.s1, c.candidates)
    return fuzzy_features(found.join(sample, PAIR))


def _fitted(c: Cards, features: DataFrame | None = None) -> matcher.Matcher:
    """The matcher; its sample is taken of ``features``, if those of all pairs are made anyway."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _matchers:
        if features is None:
            sample = _training_features(c)
        else:
            sample = matcher.training_sample(features, stage(_truth(c)))
        # The tables give about a thousand rows to train on: small leaves and large steps.
        settings = matcher.TreeSettings(step=0.3, min_rows_per_leaf=5)
        _matchers[key] = matcher.fit_matcher(stage(sample), settings=settings)
    return _matchers[key]


def cleaned_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all parts with planted faults (null, not a number, both infinities), as a model gets them."""
    key = F.col("p_partkey")
    faults = ((5, None), (7, "nan"), (11, "inf"), (13, "-inf"))
    price = F.col("p_retailprice").cast("double")
    for every, fault in faults:
        price = F.when(key % every == 0, F.lit(fault).cast("double")).otherwise(price)
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        key.cast("string").alias(PAIR[0]),
        F.col("p_name").alias(PAIR[1]),
        F.when(key % 3 != 0, F.col("p_size")).alias("size"),
        price.alias("price"),
    )
    return matcher.clean_features(rows, matcher.model_features(rows))


REGISTRY["cleaned_features"] = cleaned_features


@query
def matcher_scores(c: Cards) -> DataFrame:
    features = _fuzzy_features(c)
    fitted = _fitted(c, features)
    return matcher.score_pairs(fitted.model, features, fitted.features, fitted.threshold)


@query
def matcher_importance(c: Cards) -> DataFrame:
    return _fitted(c).importance


@query
def matcher_metrics(c: Cards) -> DataFrame:
    return _fitted(c).metrics


@query
def matcher_confusion(c: Cards) -> DataFrame:
    """Quality over all candidate pairs, not only over the training sample."""
    features = _fuzzy_features(c)
    fitted = _fitted(c, features)
    scored = matcher.score_pairs(fitted.model, features, fitted.features, fitted.threshold)
    return metrics.confusion(matcher.label_pairs(scored, _truth(c)))


# --- outputs -----------------------------------------------------------------


def _predicted(c: Cards) -> tuple[DataFrame, DataFrame]:
    """Candidates, and as positives those that agree in name and address."""
    features = stage(_numeric_features(c))
    both = (F.col("name_exact") == 1) & (F.col("address_exact") == 1)
    predictions = features.select(*PAIR, both.cast("int").alias("prediction"))
    return features.select(*PAIR), predictions


@query
def predicted_pairs(c: Cards) -> DataFrame:
    return outputs.positive_pairs(_predicted(c)[1])


@query
def output_matches(c: Cards) -> DataFrame:
    return outputs.build_outputs(c.s1, *_predicted(c))[0]


@query
def output_candidates(c: Cards) -> DataFrame:
    return outputs.build_outputs(c.s1, *_predicted(c))[1]


def _new_path(c: Cards) -> str:
    """In the application's part of the shared folder, as staged tables."""
    return f"{shared_folder(c.spark)}/{c.spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


@query
def output_read_back(c: Cards) -> DataFrame:
    path = _new_path(c)
    write_tsv(outputs.build_outputs(c.s1, *_predicted(c))[0], path, sort_by=PAIR[0])
    return read_id_lists(c.spark, path, "matched_entity_ids")


@query
def output_checks(c: Cards) -> DataFrame:
    matches, candidates = outputs.build_outputs(c.s1, *_predicted(c))
    return outputs.validate_outputs(stage(matches), stage(candidates), c.s1, c.s2, c.s3)


@query
def output_checks_wrong_table(c: Cards) -> DataFrame:
    """Lists of S1 checked as if S2 were the reference list: counts and ids do not fit."""
    matches, candidates = outputs.build_outputs(c.s1, *_predicted(c))
    return outputs.validate_outputs(stage(matches), stage(candidates), c.s2, c.s3, c.s3)


@query
def output_checks_planted(c: Cards) -> DataFrame:
    """Lists with planted faults: a row of every entity whose number ends in 7 is repeated, and
    every entity whose number ends in 3 gets a match that is neither a candidate nor known."""
    matches, candidates = outputs.build_outputs(c.s1, *_predicted(c))
    repeated = F.col(PAIR[0]).endswith("7")
    stray = F.concat(F.lit("stray-"), F.col(PAIR[0]))
    listed = F.when(F.col("matched_entity_ids") == "", stray).otherwise(
        F.concat_ws(",", "matched_entity_ids", stray)
    )
    marred = matches.withColumn(
        "matched_entity_ids",
        F.when(F.col(PAIR[0]).endswith("3"), listed).otherwise(F.col("matched_entity_ids")),
    )
    twice = lambda df: df.unionByName(df.where(repeated))
    return outputs.validate_outputs(stage(twice(marred)), stage(twice(candidates)), c.s1, c.s2, c.s3)


# --- files written and read back -----------------------------------------------


@query
def tsv_read_back(c: Cards) -> DataFrame:
    """The second table written to a path replaces the first; empty texts come back as NULL."""
    path = f"{_new_path(c)}.tsv"
    write_tsv(c.s1.select(*ENTITY), path)
    write_tsv(c.candidates.select(*ENTITY), path)
    return read_entities(c.spark, path)


@query
def parquet_read_back(c: Cards) -> DataFrame:
    path = f"{_new_path(c)}.parquet"
    write_parquet(c.s1, path)
    write_parquet(c.candidates, path, codec=None)
    return read_entities(c.spark, path, [*ENTITY, "country"])


@query
def sorted_file_order(c: Cards) -> DataFrame:
    """How many rows of a sorted export stand after a larger id, in their file or an earlier one."""
    path = f"{_new_path(c)}.tsv"
    write_tsv(c.candidates.select(*ENTITY), path, sort_by="entity_id")
    rows = c.spark.read.csv(path, sep="\t", header=True, schema=text_schema(ENTITY)).select(
        "entity_id",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    inside = Window.partitionBy("file").orderBy("block", "place")
    files = (
        rows.withColumn("before", F.lag("entity_id").over(inside))
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("before") > F.col("entity_id")).alias("inside"),
            F.min("entity_id").alias("first"),
            F.max("entity_id").alias("last"),
        )
    )
    # One row per file from here on.
    late = F.lag("last").over(Window.orderBy("file")) > F.col("first")
    return files.withColumn("late", F.coalesce(late, F.lit(False)).cast("long")).agg(
        F.sum("rows").alias("rows"), F.sum(F.col("inside") + F.col("late")).alias("misplaced")
    )


@query
def positive_pairs_read_back(c: Cards) -> DataFrame:
    path = _new_path(c)
    write_positive_pairs(_predicted(c)[1], path)
    return c.spark.read.csv(path, sep="\t", header=True, schema=text_schema(PAIR))


@query
def report_read_back(c: Cards) -> DataFrame:
    path, sweep = _new_path(c), threshold_sweep(c)
    write_report(sweep, path)
    return c.spark.read.csv(path, header=True, schema=sweep.schema)


@query
def record_read_back(c: Cards) -> DataFrame:
    path, best = _new_path(c), best_threshold(c)
    write_record(best, path)
    return c.spark.read.schema(best.schema).json(path)


@query
def matcher_checks(c: Cards) -> DataFrame:
    """A fitted matcher saved, loaded and applied to all pairs, and what must hold of its files."""
    features = _fuzzy_features(c)
    fitted = _fitted(c, features)
    folder = _new_path(c)
    save_matcher(fitted, folder)
    table = f"{folder}/features.parquet"
    write_parquet(features, table)
    scored = score_job(c.spark, table, folder, f"{folder}/scores", f"{folder}/positives")
    first = score_job(c.spark, table, folder, f"{folder}/first", limit=10)
    threshold = c.spark.read.json(f"{folder}/threshold.json").first()["threshold"]
    importance = c.spark.read.csv(
        f"{folder}/feature_importance.csv", header=True, schema="feature string, importance double"
    )
    listed = c.spark.read.csv(f"{folder}/positives", sep="\t", header=True, schema=text_schema(PAIR))
    p = F.col("match_probability")
    said = scored.where("prediction = 1").select(*PAIR)
    counts = metrics.confusion(matcher.label_pairs(scored, _truth(c)))
    return one_row(
        pairs=count_rows(scored),
        outside_unit_range=count_rows(scored.where(p.isNull() | ~p.between(0, 1))),
        wrong_predictions=count_rows(scored.where(F.col("prediction") != (p >= threshold).cast("int"))),
        wrongly_listed=count_rows(listed.exceptAll(said).unionByName(said.exceptAll(listed))),
        known_matches=counts.select(F.expr("true_positives + false_negatives").alias("n")),
        others=counts.select(F.expr("false_positives + true_negatives").alias("n")),
        features=count_rows(importance),
        importance_millionths=importance.agg(F.round(F.sum("importance") * 1e6).alias("n")),
        sweep_rows=count_rows(c.spark.read.csv(f"{folder}/threshold_search.csv", header=True)),
        first_rows_scored=count_rows(first.join(scored, [*PAIR, "match_probability"], "left_semi")),
    )
