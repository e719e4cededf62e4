"""The match model: labelled sample, training, validation, scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.operators.metrics import best_threshold, confusion, ranking_quality, threshold_sweep
from twinfold.operators.sampling import grouped_split, keyed_sample
from twinfold.operators.truth import explode_id_list
from twinfold.session import shared_folder, stage
from twinfold.sources.entities import PAIR, require_columns

NOT_FEATURES = {*PAIR, "label"}


def model_features(df: DataFrame) -> list[str]:
    """Every column that is neither an id nor the label."""
    names = [c for c in df.columns if c not in NOT_FEATURES]
    if not names:
        raise ValueError("no feature columns")
    return names


def clean_features(df: DataFrame, names: list[str]) -> DataFrame:
    """Features as doubles with NULL, NaN and infinite values as 0."""
    fixed = {}
    for name in names:
        value = F.col(name).cast("double")
        odd = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
        fixed[name] = F.when(odd, F.lit(0.0)).otherwise(value)
    return df.withColumns(fixed)


def label_pairs(features: DataFrame, truth: DataFrame) -> DataFrame:
    """All pairs with ``label`` 1 where the truth lists them, else 0."""
    known = explode_id_list(truth).withColumn("label", F.lit(1))
    return features.join(known, PAIR, "left").fillna(0, ["label"])


def training_positives(features: DataFrame, truth: DataFrame) -> DataFrame:
    return features.join(explode_id_list(truth), PAIR).withColumn("label", F.lit(1))


def training_negatives(features: DataFrame, truth: DataFrame) -> DataFrame:
    return features.join(explode_id_list(truth), PAIR, "left_anti").withColumn("label", F.lit(0))


def training_sample(
    features: DataFrame,
    truth: DataFrame,
    max_negatives: int = 2_000_000,
    negative_ratio: int = 5,
    seed: int = 42,
) -> DataFrame:
    """All true candidate pairs and a reproducible sample of the others, as a
    written table: training reads it many times."""
    require_columns(features, PAIR, "features")
    positives = stage(training_positives(features, truth))
    found = positives.count()
    if found == 0:
        raise ValueError("no true pair is among the candidates")
    others = training_negatives(features, truth)
    negatives = stage(keyed_sample(others, min(max_negatives, found * negative_ratio), PAIR, seed))
    if negatives.isEmpty():
        raise ValueError("no candidate pair is left as a negative")
    return positives.unionByName(negatives)


@dataclass
class Matcher:
    """A fitted model with what is needed to apply and judge it."""

    model: PipelineModel
    features: list[str]
    threshold: float
    sweep: DataFrame | None = None
    metrics: DataFrame | None = None
    importance: DataFrame | None = None


@dataclass(frozen=True)
class TreeSettings:
    """Boosted trees: small steps, rows and columns subsampled; of at most ``rounds``
    the round with the least held-out loss, after ``patience`` rounds without a gain."""

    rounds: int = 1000
    patience: int = 75
    step: float = 0.05
    depth: int = 6
    min_rows_per_leaf: int = 50
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    extra: dict = field(default_factory=dict)

    def classifier(self, rounds: int) -> GBTClassifier:
        return GBTClassifier(
            featuresCol="feature_vector",
            labelCol="label",
            maxIter=rounds,
            stepSize=self.step,
            maxDepth=self.depth,
            minInstancesPerNode=self.min_rows_per_leaf,
            subsamplingRate=self.row_share,
            featureSubsetStrategy=str(self.column_share),
            checkpointInterval=10,
            seed=self.seed,
            **self.extra,
        )


# Rounds that are fitted before the held-out loss is looked at: three times the patience.
FIRST_ROUNDS = 225
# Rows to train on for each task of a round; a round is mostly the start of its jobs.
FIT_ROWS = 16_384


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) with the least loss before ``patience`` rounds bring no gain, and
    whether they did."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def rounds_of_next_fit(best: int, patience: int, rounds: int, step: int) -> tuple[int, int]:
    """How many rounds to fit after a fit of ``rounds`` that did not stop, and the next ``step``.

    Training cannot stop before ``best + patience`` rounds.  If the loss has not fallen for a quarter
    of the patience, it likely stops just there, so that is looked at first, once a step; else three
    times as many rounds are fitted, as every fit begins anew.
    """
    soonest = best + patience
    if rounds == step and rounds - best >= max(1, patience // 4):
        return soonest, step
    longer = max(3 * step, soonest)
    return longer, longer


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after its first ``rounds`` rounds.

    A round adds a tree and leaves those before it alone, so nothing is fitted again.
    """
    java, context = model._java_obj, SparkContext._active_spark_context
    trees = context._gateway.new_array(
        context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds
    )
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for at, (tree, weight) in enumerate(zip(java.trees()[:rounds], java.treeWeights()[:rounds])):
        trees[at], weights[at] = tree, weight
    kind = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel
    cut = kind(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    for column in ("Features", "Prediction", "RawPrediction", "Probability"):
        getattr(cut, f"set{column}Col")(getattr(model, f"get{column}Col")())
    found = GBTClassificationModel(cut)
    found._transfer_params_from_java()
    return found


def _fit_trees(train: DataFrame, judge: DataFrame, settings: TreeSettings) -> GBTClassificationModel:
    """The trees up to the best round on ``judge``.

    Rounds do not depend on how many follow, so fits of different length over the same written
    table begin with the same trees, and the best round is cut out of the last fit.
    """
    rounds = step = min(FIRST_ROUNDS, settings.rounds)
    while True:
        model = settings.classifier(rounds).fit(train)
        best, stopped = best_round(model.evaluateEachIteration(judge), settings.patience)
        if stopped or rounds == settings.rounds:
            return model if best == rounds else first_trees(model, best)
        rounds, step = rounds_of_next_fit(best, settings.patience, rounds, step)
        rounds = min(rounds, settings.rounds)


def rows_to_fit(df: DataFrame, assembler: VectorAssembler) -> DataFrame:
    """Feature vectors and labels of a written table, in an order that only its rows decide.

    Rounds draw rows by their place, so the same rows in the same places give the same trees.  The plan
    before the vectors is cut off, as each of the thousands of jobs would carry it.
    """
    tasks = max(-(-df.count() // FIT_ROWS), 1)
    dealt = assembler.transform(df).repartition(tasks, *PAIR).sortWithinPartitions(*PAIR)
    return dealt.select("feature_vector", "label").checkpoint()


def _importance(spark: SparkSession, model: PipelineModel, names: list[str]) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def fit_matcher(
    sample: DataFrame,
    validation_share: float = 0.2,
    settings: TreeSettings | None = None,
) -> Matcher:
    """Train on part of the entities, choose the threshold on the rest.

    If the rest holds no positive pair, all rows are trained on, and the round and the
    threshold are chosen on them too.
    """
    settings = settings or TreeSettings()
    spark = sample.sparkSession
    shared_folder(spark)
    names = model_features(sample)
    cleaned = clean_features(sample, names)
    train, valid = grouped_split(cleaned, validation_share, PAIR[0], settings.seed)
    held_out = not valid.where("label = 1").isEmpty()
    assembler = VectorAssembler(inputCols=names, outputCol="feature_vector")
    if held_out:
        train, judge = stage(train), stage(valid)
    else:
        train = judge = stage(cleaned)
    trees = _fit_trees(rows_to_fit(train, assembler), assembler.transform(judge), settings)
    model = PipelineModel(stages=[assembler, trees])
    judged = stage(
        _probabilities(model, judge).select(*PAIR, "label", "match_probability")
    )
    sweep = threshold_sweep(judged)
    best = best_threshold(sweep).first()
    chosen = judged.withColumn(
        "prediction", (F.col("match_probability") >= best["threshold"]).cast("int")
    )
    metrics = _metrics(spark, best, chosen, model)
    return Matcher(
        model, names, best["threshold"], sweep, metrics, _importance(spark, model, names)
    )


def _metrics(spark: SparkSession, best, chosen: DataFrame, model: PipelineModel) -> DataFrame:
    counts = confusion(chosen).first().asDict()
    ranks = ranking_quality(chosen).first().asDict()
    positives = counts["true_positives"] + counts["false_negatives"]
    negatives = counts["true_negatives"] + counts["false_positives"]
    row = {
        "threshold": best["threshold"],
        **{k: counts[k] for k in ("precision", "recall", "f0_5")},
        **ranks,
        **{k: v for k, v in counts.items() if k.endswith("tives")},
        "validation_rows": positives + negatives,
        "validation_positives": positives,
        "validation_negatives": negatives,
        "best_iteration": model.stages[-1].getNumTrees,
    }
    kinds = {int: "long", float: "double", type(None): "double"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema)


def _probabilities(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn(
        "match_probability", vector_to_array("probability")[1]
    )


def score_pairs(
    model: PipelineModel,
    features: DataFrame,
    names: list[str],
    threshold: float,
    limit: int | None = None,
) -> DataFrame:
    """Probability and 0/1 prediction of each pair; ``limit`` scores only the
    first rows by pair id."""
    require_columns(features, [*PAIR, *names], "features")
    rows = features.select(*PAIR, *names)
    if limit is not None:
        rows = rows.orderBy(*PAIR).limit(limit)
    scored = _probabilities(model, clean_features(rows, names))
    return scored.select(
        *PAIR,
        "match_probability",
        (F.col("match_probability") >= threshold).cast("tinyint").alias("prediction"),
    )
