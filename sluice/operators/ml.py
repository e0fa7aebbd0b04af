"""Feature preparation, model fitting, scoring and evaluation on Spark ML."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import durable, scratch_path
from sluice.skew import spread_join

# Class that stands for missing values when labels are encoded (fixed value).
MISSING = "nan"


def add_indicators(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """0/1 columns; an unknown condition is 0."""
    return df.withColumns({n: F.coalesce(c.cast("int"), F.lit(0)) for n, c in conditions.items()})


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls become the column mean, computed by one aggregate inside the same plan."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means.select(c).scalar()) for c in cols})


def _label(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def label_table(df: DataFrame, col: str) -> DataFrame:
    """The encoder: rows (value, code), codes 0..n-1 in text order.

    The distinct values are sorted across tasks by range, numbered inside each range,
    and shifted by the sizes of the ranges before. The ranges are checkpointed, because
    range boundaries come from a sample and must not change between the two steps.
    """
    values = df.select(_label(F.col(col)).alias("value")).distinct()
    ranges = durable(values.repartitionByRange("value").withColumn("_p", F.spark_partition_id()))
    sizes = ranges.groupBy("_p").agg(F.count(F.lit(1)).alias("n"))
    # One row per range: as many rows as there are shuffle partitions.
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy("value")) - 1
    numbered = ranges.withColumn("_i", own).join(starts, "_p")
    return numbered.select("value", (F.col("start") + F.col("_i")).alias("code"))


def label_encode(df: DataFrame, col: str, out: str, table: DataFrame | None = None) -> DataFrame:
    table = label_table(df, col) if table is None else table
    work = df.withColumn("_value", _label(F.col(col)))
    return spread_join(work, table.withColumnRenamed("code", out), [("_value", "value")]).drop("_value")


def unit_interval(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def assign_split(df: DataFrame, key: str, weights: Mapping[str, float], seed: int = 0, out: str = "part") -> DataFrame:
    """Label every row with its part; the same key always lands in the same part."""
    u = unit_interval(F.col(key), seed)
    total, upper = sum(weights.values()), 0.0
    *firsts, last = weights
    part = None
    for name in firsts:
        upper += weights[name] / total
        part = F.when(u < upper, name) if part is None else part.when(u < upper, name)
    return df.withColumn(out, F.lit(last) if part is None else part.otherwise(last))


def split(df: DataFrame, key: str, weights: Mapping[str, float], seed: int = 0) -> dict[str, DataFrame]:
    marked = assign_split(df, key, weights, seed, "_part")
    return {n: marked.where(F.col("_part") == n).drop("_part") for n in weights}


def assemble(df: DataFrame, features: Sequence[str] | str, out: str = "features") -> DataFrame:
    """Feature vector from numeric columns, or from one array column."""
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.col(features)))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def detached(model: Model, df: DataFrame) -> Model:
    """The model without its training summary, by way of the shared folder.

    A summary holds the session. Once the session has observed a metric it cannot be
    sent to executors any more (Spark 4.1), and with it no model that has a summary.
    """
    path = scratch_path(df.sparkSession, "model")
    model.save(path)
    return type(model).load(path)


def fit_logistic(
    df: DataFrame, features: Sequence[str] | str, label: str,
    c: float = 1.0, l1_ratio: float = 0.0, max_iter: int = 100,
) -> Model:
    """Logistic regression; ``c`` is the inverse regularisation strength over the summed loss."""
    data = assemble(df, features)
    estimator = LogisticRegression(
        labelCol=label, maxIter=max_iter, elasticNetParam=l1_ratio, regParam=1.0 / (c * max(1, df.count()))
    )
    return detached(estimator.fit(data), data)


def fit_forest(
    df: DataFrame, features: Sequence[str] | str, label: str,
    n_estimators: int = 100, min_samples_leaf: int = 1, max_depth: int = 5, max_features: str = "sqrt", seed: int = 0,
) -> Model:
    estimator = RandomForestClassifier(
        labelCol=label, numTrees=n_estimators, minInstancesPerNode=min_samples_leaf, maxDepth=max_depth,
        featureSubsetStrategy=max_features, seed=seed,
    )
    data = assemble(df, features)
    return detached(estimator.fit(data), data)


def sample_grid(estimator, ranges: Mapping[str, tuple], n: int, seed: int = 0) -> list[dict]:
    """``n`` random settings. A range is ("integer", lo, hi), ("continuous", lo, hi) or ("categorical", values)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        setting = {}
        for name, (kind, *bounds) in ranges.items():
            param = estimator.getParam(name)
            if kind == "integer":
                setting[param] = rng.randint(*bounds)
            elif kind == "continuous":
                setting[param] = rng.uniform(*bounds)
            else:
                setting[param] = rng.choice(list(bounds[0]))
        out.append(setting)
    return out


class Tuned(NamedTuple):
    """Best model, fitted on all rows, its setting, and the score of every setting tried."""

    model: Model
    setting: dict
    scores: list[float]


def tune(
    df: DataFrame, estimator, ranges: Mapping[str, tuple], evaluator: Evaluator,
    n: int = 40, parallelism: int = 4, seed: int = 0, train_ratio: float = 0.7, *, key: str,
) -> Tuned:
    """Random search: fit on one part of the rows, score on the other, ``parallelism`` fits at a time.

    ``key`` decides the part of a row, so a row never is in both, whoever reads it again.
    """
    settings = sample_grid(estimator, ranges, n, seed)
    parts = split(df, key, {"train": train_ratio, "valid": 1 - train_ratio}, seed)
    train, valid = parts["train"], parts["valid"]

    def trial(setting: dict) -> float:
        return evaluator.evaluate(detached(estimator.fit(train, setting), df).transform(valid))

    with ThreadPool(parallelism) as pool:
        scores = pool.map(trial, settings)
    best = settings[scores.index(max(scores) if evaluator.isLargerBetter() else min(scores))]
    return Tuned(detached(estimator.fit(df, best), df), best, scores)


def score(df: DataFrame, model: Model, features: Sequence[str] | str, keep: Sequence[str], out: str = "prediction") -> DataFrame:
    """Kept input columns and the prediction."""
    pred = model.getPredictionCol()
    return model.transform(assemble(df, features, model.getFeaturesCol())).select(*keep, F.col(pred).alias(out))


def pair_counts(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Rows (y, y_pred, n): one per pair of classes, combined before the shuffle."""
    return df.groupBy(F.col(y).cast("string").alias("y"), F.col(y_pred).cast("string").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_counts(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Rows (class, tp, actual, predicted)."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    same = F.col("y") == F.col("y_pred")
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.when(same, n).otherwise(zero).alias("tp"), n.alias("actual"), zero.alias("predicted")),
        F.struct(F.col("y_pred").alias("class"), zero.alias("tp"), zero.alias("actual"), n.alias("predicted")),
    )
    return pair_counts(df, y, y_pred).select(F.inline(sides)).groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted")
    )


def class_metrics(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Rows (metric, score): accuracy and the macro averages; a ratio over nothing is 0."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    per = class_counts(df, y, y_pred).withColumns(
        {"p": ratio(F.col("tp"), F.col("predicted")), "r": ratio(F.col("tp"), F.col("actual"))}
    ).withColumn("f", ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    one = per.agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        F.avg("p").alias("precision"),
        F.avg("r").alias("recall"),
        F.avg("f").alias("f1"),
    )
    return one.unpivot([], ["accuracy", "precision", "recall", "f1"], "metric", "score")


def confusion(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return pair_counts(df, y, y_pred).groupBy("y").pivot("y_pred").agg(F.sum("n")).na.fill(0)


def one_vs_rest(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Rows (class, tn, fp, fn, tp)."""
    per = class_counts(df, y, y_pred)
    rows = per.agg(F.sum("actual").alias("n")).scalar()
    return per.select(
        "class",
        (rows - F.col("actual") - F.col("predicted") + F.col("tp")).alias("tn"),
        (F.col("predicted") - F.col("tp")).alias("fp"),
        (F.col("actual") - F.col("tp")).alias("fn"),
        "tp",
    )


def auc(df: DataFrame, label: str, raw: str = "rawPrediction") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw).evaluate(df)
