"""twinfold: record linkage as Spark jobs.

Three tables of names, addresses and countries go in (a reference list and
two noisy candidate tables); candidate pairs, pair features, a trained matcher
and one-row-per-entity match lists come out.  Every public function takes and
returns DataFrames; see ``twinfold.plans.jobs`` for the path-to-path jobs.
"""

from twinfold.operators.exact import capped_block, exact_block, exact_pair_total
from twinfold.operators.features import pair_features
from twinfold.operators.matcher import fit_matcher, score_pairs, training_sample
from twinfold.operators.metrics import (
    average_precision,
    best_threshold,
    confusion,
    roc_auc,
    threshold_sweep,
)
from twinfold.operators.ngrams import ngram_block
from twinfold.operators.outputs import (
    assert_valid,
    build_outputs,
    validate_outputs,
)
from twinfold.operators.pairs import block_coverage, new_pairs, union_pairs
from twinfold.operators.profile import (
    blank_counts,
    country_distribution,
    duplicate_counts,
    frequency_summary,
    profile_table,
    top_values,
    value_frequencies,
)
from twinfold.operators.sampling import grouped_split, keyed_sample
from twinfold.operators.similarity import fuzzy_features
from twinfold.operators.tokens import (
    frequency_buckets,
    rare_tokens,
    token_block,
    token_frequency,
    top_tokens,
    top_tokens_by_country,
)
from twinfold.operators.truth import (
    evaluate_blocking,
    explode_id_list,
    missed_details,
    missed_pairs,
)
from twinfold.sources.entities import candidates_of, read_entities, require_columns

__all__ = [
    "assert_valid",
    "average_precision",
    "best_threshold",
    "blank_counts",
    "block_coverage",
    "build_outputs",
    "candidates_of",
    "capped_block",
    "confusion",
    "country_distribution",
    "duplicate_counts",
    "evaluate_blocking",
    "exact_block",
    "exact_pair_total",
    "explode_id_list",
    "fit_matcher",
    "frequency_buckets",
    "frequency_summary",
    "fuzzy_features",
    "grouped_split",
    "keyed_sample",
    "missed_details",
    "missed_pairs",
    "new_pairs",
    "ngram_block",
    "pair_features",
    "profile_table",
    "rare_tokens",
    "read_entities",
    "require_columns",
    "roc_auc",
    "score_pairs",
    "threshold_sweep",
    "token_block",
    "token_frequency",
    "top_tokens",
    "top_tokens_by_country",
    "top_values",
    "training_sample",
    "union_pairs",
    "validate_outputs",
    "value_frequencies",
]
