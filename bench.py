"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from twinfold.plans.cards import Cards, line_cards, part_cards
from twinfold.plans.queries import REGISTRY, scored_lines
from twinfold.session import local_session

HEADLINE = [
    "entity_view",
    "profile_duplicates",
    "name_freq_summary",
    "token_buckets",
    "token_country_top15",
    "exact_name_pairs",
    "block_capped",
    "block_name_tokens",
    "block_combined",
    "ngram_topk",
    "blocking_quality",
    "missed_details",
    "pair_features_lines",
    "fuzzy_features_parts",
    "fuzzy_features_lines",
    "train_sample",
    "fuzzy_neighbours",
    "matcher_metrics",
    "threshold_sweep",
    "roc_auc",
    "average_precision",
    "output_candidates",
    "output_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = local_session(cores, shuffle_partitions=2 * int(cores))
    spark.range(1).count()  # starts the engine; not part of any query
    timings = {}
    # Tables that several queries share, so that no query pays for another.
    shared = {
        "prepare_line_cards": lambda: Cards(spark, sf_dir, line_cards),
        "prepare_part_cards": lambda: Cards(spark, sf_dir, part_cards),
        "prepare_scored_lines": lambda: scored_lines(Cards(spark, sf_dir, line_cards)),
    }
    for name, build in shared.items():
        start = time.perf_counter()
        build()
        timings[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "record_linkage_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
