"""Fitted models find a planted signal, stay in range and survive saving."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, PROBABILITY, TIME, BoostedSettings, LinearSettings
from ebbtide.models.boosted import fit_boosted
from ebbtide.models.importance import boosted_importance, boosted_splits, linear_importance, split_counts, top_features
from ebbtide.models.risk_model import RiskModel, balanced_weight
from ebbtide.operators.metrics import ranked_scores, roc_auc
from ebbtide.plans import training
from ebbtide.plans.queries import SHORT
from ebbtide.plans.scoring_run import percentile_bounds, percentile_scores, score_customers

START = datetime(2024, 1, 1, 5)


@pytest.fixture(scope="module")
def activity(spark):
    """Half of the customers come nearly every day; the others stop for good at some point."""
    rng = random.Random(3)
    rows = []
    for c in range(120):
        last = 60 if c % 2 else rng.uniform(3, 60)
        day = rng.random()
        while day < last:
            kind = rng.choice(["order", "emarsys_open", "emarsys_click", "emarsys_sessions_view"])
            rows.append((f"c{c}", (START + timedelta(days=day)).isoformat(sep=" "), kind))
            day += rng.expovariate(1.2 if c % 2 else 0.5)
    log = spark.createDataFrame(rows, f"{ID} string, {TIME} string, {KIND} string")
    return log.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def data(activity):
    return training.training_set(activity, SHORT)


@pytest.fixture(scope="module")
def boosted(data):
    return training.train_boosted(data, BoostedSettings(rounds=8, depth=3, rows_per_leaf=10))


@pytest.fixture(scope="module")
def linear(data):
    return training.train_linear(data, LinearSettings(max_iterations=30))


@pytest.mark.parametrize("kind", ["boosted", "linear"])
def test_model_beats_chance_and_survives_saving(spark, data, kind, request, tmp_path):
    model = request.getfixturevalue(kind)
    evaluation = training.evaluate(model, data).collect()
    assert [r["in_sample"] for r in evaluation] == [0] + [1] * (len(evaluation) - 1)
    assert all(a["snapshot_time"] > b["snapshot_time"] for a, b in zip(evaluation, evaluation[1:]))
    assert sum(r["roc_auc"] for r in evaluation) / len(evaluation) > 0.7

    scored = {r[ID]: r[PROBABILITY] for r in model.predict(data.test, [ID]).collect()}
    assert len(scored) == data.test.count() and all(0 <= p <= 1 for p in scored.values())
    model.save(spark, f"{tmp_path}/m")
    again = RiskModel.load(spark, f"{tmp_path}/m")
    assert (again.features, again.transform, again.outputs) == (model.features, model.transform, model.outputs)
    assert {r[ID]: r[PROBABILITY] for r in again.predict(data.test, [ID]).collect()} == scored


def test_boosted_importance(spark, boosted, tmp_path):
    gains = boosted_importance(spark, boosted).collect()
    assert len(gains) == 53 and sum(r["importance"] for r in gains) == pytest.approx(1)
    assert gains == sorted(gains, key=lambda r: (-r["importance"], r["feature"]))
    boosted.save(spark, f"{tmp_path}/m")
    splits = {r["feature"]: r["importance"] for r in split_counts(spark, f"{tmp_path}/m", boosted.features).collect()}
    assert len(splits) == 53
    assert {r["feature"]: r["importance"] for r in boosted_splits(spark, boosted).collect()} == splits
    trees = boosted.stages.stages[0].trees
    assert sum(splits.values()) == sum((t.numNodes - 1) // 2 for t in trees)
    assert {f for f, n in splits.items() if n} == {r["feature"] for r in gains if r["importance"] > 0}


def test_linear_importance_leaves_out_constants(spark, linear):
    rows = linear_importance(spark, linear).collect()
    assert len(rows) == len(linear.features) < 53
    assert "has_any_activity_hist" not in linear.features
    assert all(r["abs_coef"] == abs(r["coef"]) for r in rows)
    assert [r["abs_coef"] for r in rows] == sorted((r["abs_coef"] for r in rows), reverse=True)


def test_calibrated_scores_match_the_rate(data, linear):
    row = linear.predict(data.train, [ID, SHORT.target]).agg(
        F.avg(PROBABILITY).alias("p"), F.avg(SHORT.target).alias("y")
    ).first()
    assert row["p"] == pytest.approx(row["y"], abs=0.1)


def test_weights_balance_the_classes(data):
    weighted = data.train.withColumn("w", balanced_weight(data.train, SHORT.target))
    sums = [r["s"] for r in weighted.groupBy(SHORT.target).agg(F.sum("w").alias("s")).collect()]
    assert sums[0] == pytest.approx(sums[1]) and sum(sums) == pytest.approx(data.train.count())


def test_scoring_by_history_and_percentile(activity, boosted):
    latest = datetime(2024, 3, 1)
    everyone = score_customers(boosted, activity, latest, SHORT)
    recent = score_customers(boosted, activity, latest, SHORT, history="lookback")
    assert recent.count() < everyone.count() == 120
    assert recent.join(everyone, ID, "left_anti").count() == 0
    low, mid, top = percentile_bounds(everyone).first()
    assert low <= mid <= top
    buckets = {r["churn_bucket"]: r["count"] for r in percentile_scores(everyone, latest).groupBy("churn_bucket").count().collect()}
    assert sum(buckets.values()) == 120 and buckets["very_high"] >= 12


def test_boosting_keeps_trees_while_they_help(spark):
    """A planted signal: more than a few trees stay, and the first rows to get worse do not end it."""
    rows = spark.range(6000).select(
        (F.col("id") % 3).cast("int").alias("fold"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("noise")
    ).withColumn("y", (F.rand(4) < 0.15 + 0.7 * ((F.sin(F.col("a") * 9) + F.col("b")) > 0.6).cast("double")).cast("int")).cache()
    settings = BoostedSettings(rounds=40, depth=2, rows_per_leaf=20, first_rounds=20, patience=5)
    model = fit_boosted(rows, ["a", "b", "noise"], "y", settings, held_back=F.col("fold") == 0)
    whole = fit_boosted(rows.filter("fold <> 0"), ["a", "b", "noise"], "y", settings)
    trees = lambda m: next(s for s in m.stages.stages if hasattr(s, "trees")).trees
    assert len(trees(model)) > 10

    def auc(m):
        ranked = ranked_scores(m.predict(rows.filter("fold = 0"), ["y"]), [], PROBABILITY, "y")
        return roc_auc(ranked, []).first()["roc_auc"]

    assert auc(model) >= auc(whole) - 0.005 and auc(model) > 0.75
    assert top_features(boosted_importance(spark, model), 2).count() == 2
