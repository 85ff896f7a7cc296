"""Ranking metrics and quantiles equal brute force, also when the score axis is cut into ranges."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.config import PERCENTILE_BOUNDS
from ebbtide.operators.metrics import (
    average_precision, best_threshold, classification_metrics, ranked_scores, roc_auc, rolling_evaluation, threshold_table,
    thresholds,
)
from ebbtide.operators.ranking import exact_quantiles, per_score, running_totals


def scored_rows(seed: int, n: int = 400, groups: int = 3):
    """A third of the rows share one score."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        g = rng.randrange(groups)
        p = 0.5 if rng.random() < 1 / 3 else round(rng.random(), 3) if rng.random() < 0.5 else rng.random()
        rows.append((g, p, int(rng.random() < p * 0.8 + 0.1)))
    return rows


def brute(rows):
    pos = [p for _, p, y in rows if y]
    neg = [p for _, p, y in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for t in sorted({p for _, p, _ in rows}, reverse=True):
        here = sum(1 for _, p, y in rows if y and p == t)
        at = [y for _, p, y in rows if p >= t]
        ap += here / len(pos) * sum(at) / len(at)

    def rates(t):
        tp = sum(1 for _, p, y in rows if p >= t and y)
        fp = sum(1 for _, p, y in rows if p >= t and not y)
        return {
            "f1": 2 * tp / (tp + fp + len(pos)), "precision": tp / (tp + fp) if tp + fp else 0.0,
            "recall": tp / len(pos), "accuracy": (tp + len(neg) - fp) / len(rows),
        }

    best, best_t = -1.0, 0.5
    for t in np.linspace(0.01, 0.99, 99):
        if rates(t)["f1"] > best:
            best, best_t = rates(t)["f1"], float(t)
    return auc, ap, rates(0.5), best_t, rates(best_t)


@pytest.fixture(scope="module")
def case(spark):
    rows = scored_rows(1)
    return spark.createDataFrame(rows, "g int, p double, y int").repartition(5), rows


def test_thresholds_are_the_fixed_ones():
    assert thresholds() == list(np.linspace(0.01, 0.99, 99))


@pytest.mark.parametrize("ranging", [{"bounded": True}, {}, {"rows_per_range": 20}])
def test_rolling_evaluation_equals_brute_force(case, ranging):
    df, rows = case
    got = {r["g"]: r for r in rolling_evaluation(df, ["g"], "p", "y", **ranging).collect()}
    for g in range(3):
        mine = [r for r in rows if r[0] == g]
        auc, ap, half, t, at = brute(mine)
        r = got[g]
        assert (r["n_rows"], r["threshold_opt"]) == (len(mine), t)
        assert r["churn_rate"] == pytest.approx(sum(y for *_, y in mine) / len(mine))
        assert r["roc_auc"] == pytest.approx(auc, abs=1e-12) and r["pr_auc"] == pytest.approx(ap, abs=1e-12)
        for name in ("f1", "precision", "recall", "accuracy"):
            assert r[name] == pytest.approx(half[name]) and r[f"{name}_opt"] == pytest.approx(at[name])


def test_single_metrics_agree_with_the_chain(case):
    df, _ = case
    chain = {r["g"]: r for r in rolling_evaluation(df, ["g"], "p", "y", bounded=True).collect()}
    ranked = ranked_scores(df, ["g"], "p", "y", bounded=True)
    for r in roc_auc(ranked, ["g"]).join(average_precision(ranked, ["g"]), "g").collect():
        assert r["roc_auc"] == pytest.approx(chain[r["g"]]["roc_auc"])
        assert r["pr_auc"] == pytest.approx(chain[r["g"]]["pr_auc"])
    for r in best_threshold(threshold_table(df, ["g"], "p", "y"), ["g"]).collect():
        assert all(r[c] == chain[r["g"]][c] for c in ("threshold_opt", "f1_opt", "accuracy_opt"))
    for r in classification_metrics(df, ["g"], "p", "y").collect():
        assert all(r[c] == chain[r["g"]][c] for c in ("n_rows", "accuracy", "precision", "recall", "f1"))


def test_undefined_metrics(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0)], "g int, p double, y int")
    r = rolling_evaluation(df, ["g"], "p", "y", bounded=True).first()
    assert (r["roc_auc"], r["pr_auc"]) == (None, None)
    assert (r["f1"], r["f1_opt"], r["threshold_opt"], r["precision"]) == (0.0, 0.0, 0.01, 0.0)


def test_nan_scores_rank_last(spark):
    rows = [(0, 0.9, 1), (0, 0.2, 0), (0, float("nan"), 0), (0, float("nan"), 1)]
    r = rolling_evaluation(spark.createDataFrame(rows, "g int, p double, y int"), ["g"], "p", "y", bounded=True).first()
    assert r["roc_auc"] == pytest.approx((2 + 0 + 0.5) / 4)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("group", [["g"], []])
def test_ranges_do_not_change_running_totals(case, descending, group):
    df, _ = case
    counted = per_score(df, group, "p", {"n": F.lit(1), "pos": F.col("y")})
    plain = running_totals(counted, group, "p", ["n", "pos"], descending, bounded=True)
    cut = running_totals(counted, group, "p", ["n", "pos"], descending, rows_per_range=15)
    columns = [*group, "p", "n", "pos", "run_n", "run_pos"]
    assert sorted(map(tuple, plain.select(*columns).collect())) == sorted(map(tuple, cut.select(*columns).collect()))


@pytest.mark.parametrize("ranging", [{"bounded": True}, {}, {"rows_per_range": 10}])
def test_quantiles_equal_pandas(case, ranging):
    df, rows = case
    got = exact_quantiles(df, "p", PERCENTILE_BOUNDS, ("a", "b", "c"), **ranging).first()
    wanted = pd.Series([p for _, p, _ in rows]).quantile(list(PERCENTILE_BOUNDS)).tolist()
    assert list(got) == wanted
