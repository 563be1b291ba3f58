import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.churn import (
    ChurnModelError,
    auc_table,
    behavior_table,
    fit_churn_model,
    fit_logistic,
    score_ranges,
    split_assignment,
    training_set,
)
from tidemark.plans.driver_queries import _behavior

from .conftest import SMOKE_DIR


def test_one_class_is_rejected(sample):
    stayed = sample["events"].filter("event_name <> 'churned'")
    with pytest.raises(ChurnModelError, match="class diversity"):
        fit_churn_model(behavior_table(stayed))


def test_one_class_among_the_test_rows_is_rejected(sample):
    # a single churner cannot be on both sides of the split
    with pytest.raises(ChurnModelError):
        fit_churn_model(behavior_table(sample["events"]))


@pytest.mark.parametrize("rare", [3, 40, 5000])
def test_split_takes_a_quarter_of_each_class(spark, rare):
    data = spark.range(20_000).select(F.col("id").cast("string").alias("user_id"), (F.col("id") < rare).cast("double").alias("label"))
    out = split_assignment(data)
    got = {(r["label"], r["split"]): r["n"] for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    for label, n in ((1.0, rare), (0.0, 20_000 - rare)):
        assert got[label, "test"] == math.ceil(0.25 * n) and got[label, "train"] == n - math.ceil(0.25 * n)
    assert split_assignment(data.repartition(7)).exceptAll(out).count() == 0


def test_auc_counts_ties_half(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0.0, 1.0]), rng.choice([-3.0, 0.1, 0.1000001, 0.5, 7.0, 1e6]) if i % 2 else rng.gauss(0, 1)) for i in range(600)]
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    r = auc_table(spark.createDataFrame(rows, "label double, score double")).first()
    assert r["auc"] == pytest.approx(want, abs=1e-12) and (r["n_positive"], r["n_negative"]) == (len(pos), len(neg))
    same = spark.createDataFrame([(0.0, 2.0), (1.0, 2.0)], "label double, score double")
    assert auc_table(same).first()["auc"] == 0.5
    assert auc_table(same.filter("label = 1")).first()["auc"] is None


def test_training_set_drops_incomplete_rows(spark):
    behavior = spark.createDataFrame(
        [("kim", 4, 2, 9, 3.5, 0), ("lou", 4, 2, 9, None, 0), ("max", 0, 0, 40, 0.0, 1), ("ned", 1, 1, None, 0.0, 1)],
        "user_id string, session_count int, feature_events int, days_since_active int, revenue_total double, churned int",
    )
    assert sorted(r["user_id"] for r in training_set(behavior).collect()) == ["kim", "max"]


def test_one_outlier_does_not_fill_a_range(spark):
    scores = spark.range(20_000).select((F.col("id") / 20_000).alias("s"), F.lit(1).alias("one"))
    scores = scores.unionByName(spark.createDataFrame([(1e12, 1), (-1e15, 1)], "s double, one int")).select("s")
    sizes = score_ranges(scores, 8).groupBy("range").count().collect()
    assert len(sizes) == 64 and max(r["count"] for r in sizes) <= 2 * 20_002 / 64


def test_auc_with_outliers_and_dense_stretches(spark):
    rng = random.Random(9)
    rows = [(float(rng.random() < 0.4), rng.choice([rng.gauss(0, 1e-9), rng.gauss(5, 1), 1e300, -1e200])) for _ in range(900)]
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for side in (2, 8, 64):
        assert auc_table(spark.createDataFrame(rows, "label double, score double"), side=side).first()["auc"] == pytest.approx(want, abs=1e-12)


def plain_fit(x, y, penalty=1.0):
    """Newton's method on dense arrays."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
    return w


def test_fit_equals_a_plain_fit(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=400), rng.poisson(30, 400), rng.exponential(2000, 400)])
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 0.05 * x[:, 1] + 0.001 * x[:, 2])))).astype(float)
    data = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)], "a double, b double, c double, label double")
    model = fit_logistic(data.repartition(5), ("a", "b", "c"))
    assert np.allclose([*model.coefficients, model.intercept], plain_fit(x, y), rtol=1e-6, atol=1e-9) and model.gradient < 1e-8
    p = data.select(model.probability().alias("p")).agg(F.avg("p")).first()[0]
    assert p == pytest.approx(y.mean(), abs=1e-9)  # the intercept is free


def test_separable_classes_keep_finite_weights(spark):
    data = spark.createDataFrame([(float(i), float(i >= 5)) for i in range(10)], "a double, label double")
    model = fit_logistic(data, ("a",))
    assert np.allclose([*model.coefficients, model.intercept], plain_fit(np.arange(10.0)[:, None], np.arange(10) >= 5), rtol=1e-6)


def test_model_on_driver_tables(spark):
    d = SMOKE_DIR.replace("sf0.001", "sf0.01")
    fitted = fit_churn_model(_behavior(spark, d))
    rows = fitted["scores"].collect()
    features = fitted["model"].features
    train = [r for r in rows if r["split"] == "train"]
    w = plain_fit(np.array([[r[f] for f in features] for r in train]), np.array([r["label"] for r in train]))
    assert np.allclose([*fitted["model"].coefficients, fitted["model"].intercept], w, rtol=1e-6, atol=1e-9)
    test = [r for r in rows if r["split"] == "test"]
    pos, neg = ([r["churn_probability"] for r in test if r["label"] == y] for y in (1, 0))
    assert fitted["auc"] == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)), abs=1e-12)
    assert fitted["n_train"] + fitted["n_test"] == len(rows) == 150
