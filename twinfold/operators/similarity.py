"""String similarity of candidate pairs: four scores each for name and address.

Many pairs compare the same two texts, and a comparison takes time with the product of their
lengths.  So each different pair of texts is compared once, equal texts not at all, and comparisons
are dealt over tasks by their cost.  Sorting words and splitting them into common and own ones is
done with array functions; Python tasks only receive what needs a character comparison.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions import lcs
from twinfold.functions.lcs import lcs_lengths, window_scores
from twinfold.functions.text import text_or_empty, words
from twinfold.operators.features import RAW_TEXT
from twinfold.session import stage
from twinfold.sources.entities import require_columns

SCORES = ["ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio"]


# Workers get the two small modules with the task, so the package need not be
# installed on them.
for _module in (lcs, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)


TASK_COST = 500_000_000  # characters of one text times those of the other, for one task
PAIR_COST = 2_000  # what a comparison takes besides


def _score(common: Column, both_lengths: Column) -> Column:
    """100 * 2 * common / (sum of lengths); two empty texts are equal."""
    return F.when(both_lengths == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * common / both_lengths
    )


def _prepared(texts: DataFrame) -> DataFrame:
    """What a comparison needs of two texts ``a`` and ``b``: per side the text, its words sorted, and its
    own words sorted; the length of the common words, and whether a side has no words."""
    df = texts.withColumns({f"words_{s}": F.sort_array(words(F.col(s))) for s in "ab"})
    own = {s: F.array_join(F.array_except(f"words_{s}", f"words_{o}"), " ") for s, o in ("ab", "ba")}
    return df.select(
        "text_key",
        *(F.col(s).alias(f"text_{s}") for s in "ab"),
        *(F.array_join(f"words_{s}", " ").alias(f"sorted_{s}") for s in "ab"),
        *(own[s].alias(f"own_{s}") for s in "ab"),
        F.length(F.array_join(F.array_intersect("words_a", "words_b"), " ")).alias("shared"),
        ((F.size("words_a") == 0) | (F.size("words_b") == 0)).alias("wordless"),
    )


def _set_score(common: Column) -> Column:
    """Best of: common words against all words of either side, and the two sides'
    words with the common ones first.  Only the last needs characters compared."""
    shared, one, two = F.col("shared"), F.col("own_a"), F.col("own_b")
    gap = F.when(shared > 0, 1).otherwise(0)
    full = lambda own: shared + F.when(own > 0, own + gap).otherwise(0)
    together = _score(shared + gap + common, full(one) + full(two))
    alone = F.greatest(*[_score(shared, shared + full(own)) for own in (one, two)])
    return (
        F.when(F.col("wordless"), F.lit(0.0))
        .when((shared > 0) & ((one == 0) | (two == 0)), F.lit(100.0))
        .when(shared > 0, F.greatest(together, alone))
        .otherwise(together)
    )


def by_cost(df: DataFrame, cost: Column, key: str, task_cost: int = TASK_COST) -> DataFrame:
    """Rows dealt over tasks of about equal cost.

    Rows of similar cost, by its power of two, share tasks: as many as their whole cost asks for.  So dear
    rows do not meet in one task by chance, nor do they hold up cheap ones.  Tasks of the dearest rows
    come first, as one row may be all of a task.  At most a row per power of two reaches the driver.
    """
    power = F.floor(F.log2(cost.cast("double"))).cast("int")
    sums = df.groupBy(power.alias("power")).agg(F.sum(cost.cast("double")).alias("cost")).collect()
    placed, first, tasks = F.lit(0), 0, 0
    for power_, total in sorted(((r["power"], r["cost"]) for r in sums), reverse=True):
        n = int(total / task_cost) + 1
        placed = F.when(power == power_, F.pmod(F.xxhash64(key), F.lit(n)) + first).otherwise(placed)
        first += n
        tasks = first
    return df.repartitionById(max(tasks, 1), placed.cast("int"))


TEXTS = ("text", "sorted", "own")
LENGTHS = ", ".join(f"{t}_a long, {t}_b long" for t in TEXTS)
COMPARED = f"text_key binary, shared int, wordless boolean, {LENGTHS}, lcs_text long, lcs_sorted long, lcs_own long, window double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lengths in place of texts, and what comparing their characters gives."""
    for batch in batches:
        made = {c: batch.column(c) for c in ("text_key", "shared", "wordless")}
        texts = {f"{t}_{s}": batch.column(f"{t}_{s}").to_pylist() for t in TEXTS for s in "ab"}
        made |= {c: pa.array([*map(len, values)], pa.int64()) for c, values in texts.items()}
        for t in TEXTS:
            made[f"lcs_{t}"] = pa.array(lcs_lengths(texts[f"{t}_a"], texts[f"{t}_b"]))
        made["window"] = pa.array(window_scores(texts["text_a"], texts["text_b"]))
        yield pa.RecordBatch.from_pydict(made)


def text_scores(texts: DataFrame) -> DataFrame:
    """``text_key`` and the four scores of different texts ``a`` and ``b``, one row per key."""
    prepared = _prepared(texts)
    cost = F.length("text_a").cast("long") * F.length("text_b") + PAIR_COST
    compared = by_cost(prepared, cost, "text_key").mapInArrow(_compare, COMPARED)
    both = lambda text: F.col(f"{text}_a") + F.col(f"{text}_b")
    values = [
        _score(F.col("lcs_text"), both("text")),
        F.col("window"),
        _score(F.col("lcs_sorted"), both("sorted")),
        _set_score(F.col("lcs_own")),
    ]
    return compared.select("text_key", F.struct(*(v.alias(s) for v, s in zip(values, SCORES))).alias("found"))


def fuzzy_features(pairs: DataFrame) -> DataFrame:
    """Replaces the texts of ``pair_features`` by eight scores in [0, 100].

    Null texts are empty ones.  Pairs that compare the same texts share one comparison, found by the
    texts' digest.
    """
    require_columns(pairs, ["name1", "name2", "address1", "address2"], "pair features")
    kept = [c for c in pairs.columns if c not in RAW_TEXT]
    fields = ("name", "address")
    sides = {f: (text_or_empty(f"{f}1"), text_or_empty(f"{f}2")) for f in fields}
    digest = lambda a, b: F.unhex(F.md5(F.concat(F.length(a).cast("string"), F.lit(":"), a, b)))
    keys = {f: F.when(a != b, digest(a, b)) for f, (a, b) in sides.items()}
    # A field's two texts are equal where its key is null; words decide on the last score then.
    worded = {f: F.size(words(a)) > 0 for f, (a, _) in sides.items()}
    found = stage(
        pairs.select(
            *kept,
            *(k.alias(f"_key_{f}") for f, k in keys.items()),
            *(w.alias(f"_worded_{f}") for f, w in worded.items()),
            *(F.when(a != b, x).alias(f"_{f}_{s}") for f, (a, b) in sides.items() for s, x in zip("ab", (a, b))),
        )
    )
    each = [
        found.where(F.col(f"_key_{f}").isNotNull()).select(
            F.col(f"_key_{f}").alias("text_key"), *(F.col(f"_{f}_{s}").alias(s) for s in "ab")
        )
        for f in fields
    ]
    different = each[0].unionByName(each[1]).groupBy("text_key").agg(F.first("a").alias("a"), F.first("b").alias("b"))
    scores = stage(text_scores(stage(different)))
    out = found.drop(*(f"_{f}_{s}" for f in fields for s in "ab"))
    for f in fields:
        named = scores.select(F.col("text_key").alias(f"_key_{f}"), F.col("found").alias(f"_found_{f}"))
        out = out.join(named, f"_key_{f}", "left")
    equal = lambda f, s: F.when(F.col(f"_worded_{f}") | F.lit(s != SCORES[3]), 100.0).otherwise(0.0)
    return out.select(
        *dict.fromkeys(kept),
        *(
            F.when(F.col(f"_key_{f}").isNull(), equal(f, s)).otherwise(F.col(f"_found_{f}.{s}")).alias(f"{f}_{s}")
            for f in fields
            for s in SCORES
        ),
    )
