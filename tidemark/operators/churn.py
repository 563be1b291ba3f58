"""Behaviour table and churn model.

The training table (one row per user, with its side of the split) is stored once in the shared folder; counts, fit, scores
and AUC all read that copy. The logistic regression is fitted by Newton steps on gradient and curvature sums: one
aggregation over the training rows a step, and a handful of steps, so any engine that sums the same terms gets the same
coefficients. The driver only solves a system of a few unknowns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.time import utc_column, whole_days_clipped
from tidemark.operators.intermediate import reference_time
from tidemark.operators.predicates import feature_predicate
from tidemark.session import ensure_checkpoint_dir


class ChurnModelError(ValueError):
    """Training data has fewer than two classes."""


def behavior_table(
    events: DataFrame,
    as_of: str | datetime | None = None,
    session_event: str = K.SESSION_EVENT,
    feature_prefix: str = K.FEATURE_PREFIX,
    payment_event: str = K.PAYMENT_EVENT,
    churn_event: str = K.CHURN_EVENT,
) -> DataFrame:
    """Per-user engagement with ``days_since_active`` clipped at 0.

    The reference time defaults to the latest event time over all events, evaluated as a
    scalar subquery (one partial/final max), not a window over all rows.
    """
    ts = utc_column(events, "event_ts", strict=False)
    typed = events.select("user_id", "event_name", "revenue", ts.alias("event_ts"))
    name = F.col("event_name")
    grouped = typed.groupBy("user_id").agg(
        F.count_if(name == session_event).alias("session_count"),
        F.count_if(feature_predicate(feature_prefix, "prefix")).alias("feature_events"),
        F.sum(F.when(name == payment_event, F.coalesce(F.col("revenue"), F.lit(0))).otherwise(F.lit(0))).alias(
            "revenue_total"
        ),
        F.max("event_ts").alias("last_event_ts"),
        F.max(F.when(name == churn_event, 1).otherwise(0)).alias("churned"),
    )
    return grouped.select(
        "user_id",
        "session_count",
        "feature_events",
        "revenue_total",
        "last_event_ts",
        "churned",
        whole_days_clipped(reference_time(typed, as_of), F.col("last_event_ts")).alias("days_since_active"),
    )


def training_columns(behavior: DataFrame, features: tuple[str, ...] = K.CHURN_FEATURES) -> DataFrame:
    """Complete rows only; features as double columns and the label."""
    complete = behavior.dropna(subset=[*features, "churned"])
    return complete.select(
        "user_id",
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col("churned").cast("double").alias("label"),
    ).dropna(subset=list(features))


def training_set(behavior: DataFrame, features: tuple[str, ...] = K.CHURN_FEATURES) -> DataFrame:
    """:func:`training_columns` plus the assembled feature vector."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(training_columns(behavior, features))


# hex digits of the order number that make a split bucket: 65,536 buckets
BUCKET_DIGITS = 4
# ranges of about equal numbers of scores: RANGE_SIDE squared
RANGE_SIDE = 64


def split_order(user: Column, seed: int) -> Column:
    """The text that orders users within their class: an MD5 digest, the same in any engine and layout."""
    return F.md5(F.concat_ws(":", user.cast("string"), F.lit(str(seed))).cast("binary"))


def split_assignment(
    data: DataFrame, test_share: float = K.CHURN_TEST_SHARE, seed: int = K.CHURN_SEED, label: str = "label"
) -> DataFrame:
    """Stratified split: of each class the first ``ceil(test_share * n)`` users in digest order are the test rows.

    Users are counted per class and digest bucket. The cumulative counts (a row per class and bucket) name the one bucket
    of each class that holds the cut; only users of that bucket are ranked, so no class is sorted in one task.
    """
    marked = data.withColumn("_order", split_order(F.col("user_id"), seed)).withColumn(
        "_bucket", F.substring("_order", 1, BUCKET_DIGITS)
    )
    counts = marked.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_class = Window.partitionBy(label)
    so_far = counts.withColumn("_upto", F.sum("_n").over(by_class.orderBy("_bucket"))).withColumn(
        "_want", F.ceil(F.sum("_n").over(by_class) * F.lit(test_share))
    )
    # one row per class
    cut = so_far.filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want"))).select(
        F.col(label).alias("_class"), F.col("_bucket").alias("_cut"), (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_take")
    )
    placed = marked.join(cut, F.col(label) == F.col("_class"))
    side = F.when(F.col("_bucket") < F.col("_cut"), "test").when(F.col("_bucket") > F.col("_cut"), "train")
    clear = placed.filter(F.col("_bucket") != F.col("_cut")).withColumn("split", side)
    ranked = placed.filter(F.col("_bucket") == F.col("_cut")).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(label).orderBy("_order", "user_id"))
    )
    near = ranked.withColumn("split", F.when(F.col("_rank") <= F.col("_take"), "test").otherwise("train"))
    columns = [*data.columns, "split"]
    return clear.select(*columns).unionByName(near.select(*columns))


def class_counts(data: DataFrame, label: str = "label") -> dict[tuple[str, float], int]:
    """Rows per (split, class): at most four rows, behind every guard of the fit."""
    rows = data.groupBy("split", label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r["split"], r[label]): r["n"] for r in rows}


def check_classes(counts: dict[tuple[str, float], int]) -> None:
    """Fail unless both classes are present in the data, the training rows and the test rows."""
    for side in ("train", "test"):
        if len({c for s, c in counts if s == side}) < 2:
            raise ChurnModelError("Insufficient class diversity to train churn model.")


def score_ranges(per_score: DataFrame, side: int = RANGE_SIDE) -> DataFrame:
    """``per_score`` with the ``range`` of its score ``s``: of about ``side`` squared ranges with equal numbers of rows.

    Splitters come from a quantile sketch (one aggregation, mergeable), so an outlier or a dense stretch moves them and not
    the load. A score is placed by counting splitters in two rounds, first every ``side``-th one.
    """
    n = side * side
    shares = F.expr("array(" + ", ".join(f"{i / n!r}D" for i in range(1, n)) + ")")
    splitters = per_score.select(F.percentile_approx("s", shares, F.lit(10 * n))).scalar()
    every = F.sequence(F.lit(side), F.lit(n - side), F.lit(side))
    split = per_score.withColumn("_split", splitters)
    split = split.withColumn("_coarse", F.transform(every, lambda i: F.get("_split", i - 1)))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda q: q < F.col("s")))

    placed = split.withColumn("_part", F.coalesce(below(F.col("_coarse")), F.lit(0)))
    fine = F.slice("_split", F.col("_part") * side + 1, F.lit(side - 1))
    return placed.withColumn("range", F.col("_part") * side + below(fine)).drop("_split", "_coarse", "_part")


def auc_table(scored: DataFrame, score: str = "score", label: str = "label", side: int = RANGE_SIDE) -> DataFrame:
    """ROC AUC as one row (auc, n_positive, n_negative), ties counting half (Mann-Whitney).

    Rows are reduced to counts per distinct score. Scores fall into ranges of about equal numbers of them
    (:func:`score_ranges`); each range's negatives are summed, the sums are accumulated over the ranges (a few thousand
    rows), and a score adds those of its own range below it. No task orders more than a range. The AUC is null if a class
    is missing.
    """
    value = F.col(score).cast("double")
    per_score = scored.groupBy(value.alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    ranged = score_ranges(per_score, side)
    totals = ranged.groupBy("range").agg(F.sum("neg").alias("n"))
    before = totals.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("below"))
    inside = Window.partitionBy("range").orderBy("s")
    ranked = ranged.join(before, "range").withColumn(
        "smaller", F.col("below") + F.sum("neg").over(inside) - F.col("neg")
    )
    won = F.sum(F.col("pos").cast("double") * (F.col("smaller") + F.col("neg") * F.lit(0.5)))
    out = ranked.agg(won.alias("won"), F.sum("pos").alias("n_positive"), F.sum("neg").alias("n_negative"))
    pairs = F.col("n_positive").cast("double") * F.col("n_negative")
    return out.select(F.try_divide(F.col("won"), pairs).alias("auc"), "n_positive", "n_negative")


def stored_training_table(
    behavior: DataFrame,
    features: tuple[str, ...] = K.CHURN_FEATURES,
    test_share: float = K.CHURN_TEST_SHARE,
    seed: int = K.CHURN_SEED,
) -> DataFrame:
    """The split training table, written once to the shared folder."""
    spark = behavior.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/churn-training-{uuid.uuid4().hex}"
    plain = training_columns(behavior, features)
    stored = f"{path}/plain"
    plain.write.parquet(stored)
    split_assignment(spark.read.parquet(stored), test_share, seed).write.parquet(f"{path}/split")
    return spark.read.parquet(f"{path}/split")


@dataclass(frozen=True)
class LogisticModel:
    """Weights of an unscaled logistic regression with an intercept."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    steps: int
    gradient: float  # its length at the end over that at zero weights

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for f, w in zip(self.features, self.coefficients, strict=True):
            out = out + F.col(f) * F.lit(w)
        return out

    def probability(self) -> Column:
        """The probability of class 1."""
        return _sigmoid(self.margin())


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _sums(train: DataFrame, features: Sequence[str], weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature sums at ``weights`` (the intercept last): one aggregation of k(k+3)/2 + 1 sums."""
    x = [F.col(f) for f in features] + [F.lit(1.0)]
    k = len(x)
    margin = F.lit(float(weights[-1]))
    for c, w in zip(x[:-1], weights, strict=False):
        margin = margin + c * F.lit(float(w))
    rows = train.select("label", *features, margin.alias("_z")).withColumn("_p", _sigmoid(F.col("_z")))
    z, p, label = F.col("_z"), F.col("_p"), F.col("label")
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - label * z
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    terms = [loss, *[(p - label) * c for c in x], *[p * (F.lit(1.0) - p) * x[i] * x[j] for i, j in pairs]]
    row = rows.agg(*[F.sum(t).alias(f"t{n}") for n, t in enumerate(terms)]).first()
    curvature = np.zeros((k, k))
    for n, (i, j) in enumerate(pairs):
        curvature[i, j] = curvature[j, i] = row[1 + k + n]
    return float(row[0]), np.array(row[1 : 1 + k], float), curvature


def fit_logistic(
    train: DataFrame,
    features: tuple[str, ...] = K.CHURN_FEATURES,
    penalty: float = 1.0,
    max_steps: int = 50,
    tolerance: float = 1e-10,
) -> LogisticModel:
    """C4: weights that minimise the summed log loss plus ``penalty / 2`` times the squared weights (intercept free).

    A Newton step that does not lower the objective is halved until it does. ``train`` has the features and ``label``.
    """
    k = len(features) + 1
    ridge = np.array([penalty] * (k - 1) + [0.0])

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, curvature = _sums(train, features, weights)
        return loss + 0.5 * float(ridge @ weights**2), gradient + ridge * weights, curvature + np.diag(ridge)

    weights = np.zeros(k)
    value, gradient, curvature = at(weights)
    first, steps = max(float(np.linalg.norm(gradient)), 1e-300), 0
    while steps < max_steps and np.linalg.norm(gradient) > tolerance * first:
        scale = 1 / np.sqrt(np.maximum(np.diag(curvature), 1e-300))  # features differ by orders of magnitude
        step = scale * np.linalg.lstsq(curvature * np.outer(scale, scale), scale * gradient, rcond=None)[0]
        share = 1.0
        while True:
            steps += 1
            trial = at(weights - share * step)
            if trial[0] <= value + 1e-12 * abs(value) or share < 1e-6:
                break
            share /= 2
        if trial[0] >= value and np.linalg.norm(trial[1]) >= np.linalg.norm(gradient):
            break  # rounding: no nearer
        weights, (value, gradient, curvature) = weights - share * step, trial
    return LogisticModel(
        tuple(features), tuple(map(float, weights[:-1])), float(weights[-1]), steps, float(np.linalg.norm(gradient)) / first
    )


def fit_churn_model(
    behavior: DataFrame,
    features: tuple[str, ...] = K.CHURN_FEATURES,
    test_share: float = K.CHURN_TEST_SHARE,
    seed: int = K.CHURN_SEED,
    max_steps: int = 50,
) -> dict:
    """L2 logistic regression (C=1, unscaled), scores of all rows and ROC AUC on the held-out ones.

    Returns ``{"model", "scores", "auc", "n_train", "n_test"}``; ``scores`` is the stored training table with
    ``churn_probability``. Fitting is iterative, so this runs jobs.
    """
    data = stored_training_table(behavior, features, test_share, seed)
    counts = class_counts(data)
    check_classes(counts)
    n = {side: sum(v for (s, _), v in counts.items() if s == side) for side in ("train", "test")}
    model = fit_logistic(data.filter(F.col("split") == "train"), features, max_steps=max_steps)
    scores = data.withColumn("churn_probability", model.probability())
    auc = auc_table(scores.filter(F.col("split") == "test"), "churn_probability").first()["auc"]
    return {"model": model, "scores": scores, "auc": float(auc), "n_train": n["train"], "n_test": n["test"]}


def model_row(spark: SparkSession, fitted: dict) -> DataFrame:
    """A fit as one row: model, n_train, n_test, auc, a coefficient per feature, intercept."""
    model = fitted["model"]
    row = ("logistic_regression", fitted["n_train"], fitted["n_test"], fitted["auc"], *model.coefficients, model.intercept)
    weights = ", ".join(f"{f} double" for f in (*model.features, "intercept"))
    return spark.createDataFrame([row], f"model string, n_train long, n_test long, auc double, {weights}")


def churn_model_table(behavior: DataFrame, **kwargs) -> DataFrame:
    """C4-C6 as a one-row table."""
    return model_row(behavior.sparkSession, fit_churn_model(behavior, **kwargs))
