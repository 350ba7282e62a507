"""Label model on Spark ML: labels, features, training, evaluation, scores."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.functions.values import ratio
from daymill.operators.ranking import exact_quantiles
from daymill.session import scratch_table

# --- fixed values: features, thresholds and model settings ---
NUMERIC = ["visitor_count", "new_visitor_count", "order_buyer_count", "order_conversion_rate", "avg_stay_duration"]
CATEGORICAL = ["time_period", "entry_page_name"]
INTERACTIONS = [("visitor_count", "order_buyer_count"), ("order_conversion_rate", "avg_stay_duration")]
HIGH_CONVERSION, HIGH_VISITORS, HIGH_STAY = 0.05, 0.75, 0.7
TREES, BOOST_ROUNDS, BOOST_DEPTH, BOOST_STEP, SEED = 100, 100, 3, 0.1, 42
GRID_TREES, GRID_DEPTHS, FOLDS = (50, 100, 200), (5, 10, 30), 3

#: Categories of a column that have a slot of their own, the most frequent ones; slots that any others share by hash.
DICTIONARY, REST_SLOTS = 100_000, 4096


def entry_labels(df: DataFrame, high_value: bool = True) -> DataFrame:
    """Three 0/1 labels; a label whose column is absent is skipped.

    Both quantiles come from the same passes over ``df``, which run when this is called.
    """
    quantiles = {"visitor_count": HIGH_VISITORS} | ({"avg_stay_duration": HIGH_STAY} if high_value else {})
    present = {c: [q] for c, q in quantiles.items() if c in df.columns}
    cuts = exact_quantiles(df, present) if present else {}
    labels: dict[str, Column] = {}
    if "order_conversion_rate" in df.columns:
        labels["high_conversion"] = F.col("order_conversion_rate") >= HIGH_CONVERSION
    for column, label in (("visitor_count", "high_visitor"), ("avg_stay_duration", "high_duration")):
        if column in cuts:
            labels[label] = F.col(column) >= F.lit(cuts[column][0]).cast("double")
    if not labels:
        raise ValueError("no column to derive a label from")
    # A comparison with null is no hit, as it is for a missing number.
    return df.withColumns({name: F.coalesce(test, F.lit(False)).cast("int") for name, test in labels.items()})


def scaled_numerics(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC)) -> DataFrame:
    """Numeric columns centred and divided by the population deviation, as ``<name>_scaled``.

    The statistics are one row from one pass, used as a subquery.  A constant
    column is only centred.
    """
    present = [c for c in numeric if c in df.columns]
    values = {c: F.col(c).cast("double") for c in present}
    one_row = df.agg(
        F.struct(
            *[F.avg(v).alias(f"{c}_mean") for c, v in values.items()],
            *[F.stddev_pop(v).alias(f"{c}_dev") for c, v in values.items()],
        ).alias("s")
    ).scalar()

    def scaled(c: str) -> Column:
        spread = one_row[f"{c}_dev"]
        return (values[c] - one_row[f"{c}_mean"]) / F.when(spread == 0, 1.0).otherwise(spread)

    return df.withColumns({f"{c}_scaled": scaled(c) for c in present})


def with_interactions(df: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(INTERACTIONS)) -> DataFrame:
    """Products of scaled columns, ``<a>_x_<b>``; pairs with an absent column are skipped."""
    known = [(a, b) for a, b in pairs if f"{a}_scaled" in df.columns and f"{b}_scaled" in df.columns]
    return df.withColumns({f"{a}_x_{b}": F.col(f"{a}_scaled") * F.col(f"{b}_scaled") for a, b in known})


def entry_features(df: DataFrame) -> DataFrame:
    """Scaled numerics and their products, ready for the vector stage."""
    return with_interactions(scaled_numerics(df))


def _feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_scaled") or "_x_" in c]


def _categories(df: DataFrame) -> list[str]:
    return [c for c in CATEGORICAL if c in df.columns]


@dataclass
class Categories:
    """Dictionary of category columns: ``table`` (column_name, value, slot), and for each column the slots that are its
    values' own and those that all others share."""

    table: DataFrame
    own: dict[str, int]
    shared: dict[str, int]

    def slots(self, column: str) -> int:
        return self.own[column] + self.shared[column]


def category_dictionary(df: DataFrame, columns: Sequence[str], dictionary: int = DICTIONARY) -> Categories:
    """Slots for the values of each column, the most frequent first.

    The number of slots follows the number of values.  Only a column of more than ``dictionary`` values has shared
    slots; two of its rarer values then meet with a chance of about 1 in ``REST_SLOTS``.
    """
    path = scratch_table(df.sparkSession, "categories")
    table = df.sparkSession.createDataFrame([], "column_name string, value string, slot int")
    more: dict[str, int] = {}
    for c in columns:
        counted = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        ranked = counted.orderBy(F.col("n").desc(), "value").limit(dictionary)  # bounded, so one task may number them
        slot = (F.row_number().over(Window.orderBy(F.col("n").desc(), "value")) - 1).alias("slot")
        table = table.unionByName(ranked.select(F.lit(c).alias("column_name"), "value", slot))
        more[c] = counted.limit(dictionary + 1).count()
    table.write.parquet(path)
    table = df.sparkSession.read.schema(table.schema).parquet(path)
    own = {c: min(n, dictionary) for c, n in more.items()}
    return Categories(table, own, {c: REST_SLOTS if n > dictionary else 0 for c, n in more.items()})


def with_slots(df: DataFrame, categories: Categories) -> DataFrame:
    """``df`` with the slot of each category column as ``<column>_slot``; a null, and a value without a slot, has the
    number after the last, which sets none."""
    for c in categories.own:
        side = categories.table.where(F.col("column_name") == c).select(F.col("value").alias("__value"), F.col("slot").alias("__slot"))
        none = F.lit(categories.slots(c))
        other = F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(REST_SLOTS)) + categories.own[c] if categories.shared[c] else none
        slot = F.when(F.col(c).isNull(), none).otherwise(F.coalesce(F.col("__slot"), other))
        df = df.join(side, F.col(c).cast("string") == F.col("__value"), "left").withColumn(f"{c}_slot", slot.cast("double")).drop("__value", "__slot")
    return df


def feature_model(df: DataFrame, categories: Categories) -> PipelineModel:
    """Slots turned into one column of zeros and ones each, put together with the numeric features as one vector.

    Nothing is fitted on data: the dictionary says how many slots there are.
    """
    used = [c for c in categories.own if categories.slots(c)]
    stages: list = []
    if used:
        encoder = OneHotEncoder(inputCols=[f"{c}_slot" for c in used], outputCols=[f"{c}_set" for c in used], handleInvalid="keep")
        last = df.sparkSession.createDataFrame([tuple(float(categories.slots(c) - 1) for c in used)], [f"{c}_slot" for c in used])
        stages.append(encoder.fit(last))
    stages.append(VectorAssembler(inputCols=[*_feature_columns(df), *[f"{c}_set" for c in used]], outputCol="features", handleInvalid="keep"))
    return PipelineModel(stages)


def split_rows(df: DataFrame, key: str, test_share: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key: the same split however often a task is run."""
    slot = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(SEED)), F.lit(1000))
    cut = int(test_share * 1000)
    return df.where(slot >= cut), df.where(slot < cut)


@dataclass
class LabelModels:
    """Fitted models by label; a label with one class only holds that class instead."""

    features: PipelineModel
    models: dict[str, object]
    constants: dict[str, int]
    categories: Categories

    def vectors(self, df: DataFrame) -> DataFrame:
        return self.features.transform(with_slots(df, self.categories))


def train_label_models(
    df: DataFrame,
    labels: Sequence[str],
    key: str,
    kind: str = "random_forest",
    tune: bool = False,
    trees: int = TREES,
    depth: int = 10,
    test_share: float = 0.3,
) -> LabelModels:
    """One random forest or boosted model per label, trained on the rows that ``test_share`` leaves.

    ``tune`` searches trees and depth
    with cross validation.  Training is Spark ML's distributed tree learner;
    it passes over its rows many times, so they are written once first.
    """
    path = scratch_table(df.sparkSession, "training")
    df.select(key, *labels, *_feature_columns(df), *_categories(df)).write.parquet(path)
    df = df.sparkSession.read.parquet(path)
    present = [F.count(F.lit(1)).alias("n")]
    present += [F.min(c).alias(f"{c}_low") for c in labels] + [F.max(c).alias(f"{c}_high") for c in labels]
    seen = df.agg(*present).first()  # one row
    train, _ = split_rows(df, key, test_share)
    categories = category_dictionary(df, _categories(df))
    fitted = LabelModels(feature_model(df, categories), {}, {}, categories)
    prepared = scratch_table(df.sparkSession, "vectors")
    fitted.vectors(train).select("features", *labels).write.parquet(prepared)
    ready = df.sparkSession.read.parquet(prepared)
    for label in labels:
        if seen[f"{label}_low"] == seen[f"{label}_high"]:
            fitted.constants[label] = int(seen[f"{label}_low"])
            continue
        learner = _learner(kind, label, trees, depth)
        if tune:
            learner = _searched(learner, kind, label)
        model = learner.fit(ready)
        fitted.models[label] = model.bestModel if tune else model
    return fitted


def save_label_models(fitted: LabelModels, path: str) -> None:
    """Writes models, features, dictionary and constants below ``path``; the manifest comes last, so a set of models
    without one was not finished."""
    spark = fitted.categories.table.sparkSession
    fitted.features.write().overwrite().save(f"{path}/features")
    fitted.categories.table.write.mode("overwrite").parquet(f"{path}/categories")
    for label, model in fitted.models.items():
        model.write().overwrite().save(f"{path}/models/{label}")
    kinds = {label: type(model).__name__ for label, model in fitted.models.items()}
    held = {"models": kinds, "constants": fitted.constants, "own": fitted.categories.own, "shared": fitted.categories.shared}
    spark.createDataFrame([(json.dumps(held),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def load_label_models(spark: SparkSession, path: str) -> LabelModels:
    """What :func:`save_label_models` wrote, in any session."""
    held = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    table = spark.read.schema("column_name string, value string, slot int").parquet(f"{path}/categories")
    models = {label: MODEL_KINDS[kind].load(f"{path}/models/{label}") for label, kind in held["models"].items()}
    features = PipelineModel.load(f"{path}/features")
    return LabelModels(features, models, held["constants"], Categories(table, held["own"], held["shared"]))


MODEL_KINDS = {m.__name__: m for m in (RandomForestClassificationModel, GBTClassificationModel)}


def _learner(kind: str, label: str, trees: int, depth: int):
    if kind == "random_forest":
        return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=SEED)
    if kind == "gradient_boosting":
        return GBTClassifier(
            featuresCol="features", labelCol=label, maxIter=trees, maxDepth=BOOST_DEPTH, stepSize=BOOST_STEP, seed=SEED
        )
    raise ValueError(f"unknown model kind {kind}")


def _searched(learner, kind: str, label: str) -> CrossValidator:
    count = learner.numTrees if kind == "random_forest" else learner.maxIter
    grid = ParamGridBuilder().addGrid(count, list(GRID_TREES)).addGrid(learner.maxDepth, list(GRID_DEPTHS)).build()
    score = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    return CrossValidator(estimator=learner, estimatorParamMaps=grid, evaluator=score, numFolds=FOLDS, seed=SEED)


def score_labels(fitted: LabelModels, df: DataFrame, scored_at: Column | None = None) -> DataFrame:
    """Prediction and probability per label, stamped ``scored_at``; null without it, the clock is not read.

    A label of which training saw one class only gets that class with
    probability 1.
    """
    kept = df.columns
    out = fitted.vectors(df)
    added: list[str] = []
    for label, model in fitted.models.items():
        raw = [f"__{label}_raw", f"__{label}_probability", f"__{label}_prediction"]
        model.setRawPredictionCol(raw[0]).setProbabilityCol(raw[1]).setPredictionCol(raw[2])
        out = model.transform(out).withColumns(
            {
                f"{label}_pred": F.col(raw[2]).cast("int"),
                f"{label}_prob": vector_to_array(F.col(raw[1]))[1],
            }
        )
        added += [f"{label}_pred", f"{label}_prob"]
    for label, value in fitted.constants.items():
        out = out.withColumns({f"{label}_pred": F.lit(value), f"{label}_prob": F.lit(1.0)})
        added += [f"{label}_pred", f"{label}_prob"]
    when = scored_at if scored_at is not None else F.lit(None).cast("timestamp")
    return out.select(*kept, *added, when.alias("prediction_time"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts.

    A ratio without a denominator counts as 1.
    """
    counts = confusion(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hit")),
    )
    per = counts.select(F.inline(sides)).groupBy("class").agg(
        F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit")
    )
    one = F.lit(1.0)
    precision, recall = F.col("hit") / F.nullif("guessed", F.lit(0)), F.col("hit") / F.nullif("support", F.lit(0))
    f1 = 2 * F.col("hit") / F.nullif(F.col("guessed") + F.col("support"), F.lit(0))
    return per.select(
        "class",
        F.round(F.coalesce(precision, one), 4).alias("precision"),
        F.round(F.coalesce(recall, one), 4).alias("recall"),
        F.coalesce(f1, one).alias("f1"),
        "support",
        "hit",
    )


def evaluate_labels(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Accuracy and macro F1 of each label, by pairs of label and prediction column."""

    def one(label: str, prediction: str) -> DataFrame:
        return class_report(df, label, prediction).agg(
            F.lit(label).alias("label"),
            ratio(F.sum("hit"), F.sum("support"), 4).alias("accuracy"),
            F.round(F.avg("f1"), 4).alias("macro_f1"),
            F.sum("support").alias("rows"),
        )

    frames = [one(*pair) for pair in pairs]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def area_under_roc(df: DataFrame, label: str, score: str) -> float:
    """ROC AUC of a probability column."""
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score").evaluate(rows)


def mean_importance(fitted: LabelModels) -> list[float]:
    """Feature importance, averaged over the labels."""
    vectors = [m.featureImportances.toArray() for m in fitted.models.values()]
    return [float(x) for x in sum(vectors) / len(vectors)] if vectors else []


def without_decimals(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the types the score table wants."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})
