"""The plans are the ones that hold at scale."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from conftest import SMALL

from ebbtide.config import SNAPSHOT
from ebbtide.operators import snapshots as snap
from ebbtide.operators.activity import activity_filter
from ebbtide.operators.features import STEP, customer_features
from ebbtide.operators.metrics import rolling_evaluation
from ebbtide.plans import queries
from ebbtide.sources import sample_logs as logs
from ebbtide.sources.activity_store import write_by_month

T = datetime(2001, 6, 1, 12)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "log")
    write_by_month(activity_filter(logs.long_log(spark, SMALL)), path)
    return spark.read.parquet(path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange (?:hash|single|range|Round)", plan))


def is_declarative(plan: str) -> bool:
    return not re.search(r"Expand|Python|CartesianProduct|NestedLoop|InPandas", plan)


def test_features_shuffle_twice_and_combine_first(stored):
    plan = plan_of(customer_features(stored, T))
    assert is_declarative(plan)
    assert exchanges(plan) == 2
    # The first shuffle is fed by partial counts; the second moves combined rows.
    assert plan.count("partial_count") >= 1 and "REPARTITION_BY_NUM" in plan
    assert "LessThanOrEqual(event_time" in plan


def test_all_snapshots_cost_one_scan_and_the_same_shuffles(stored):
    calendar = snap.calendar_between(datetime(1995, 1, 1), datetime(2001, 11, 4))
    assert calendar.pooled == 79
    plan = plan_of(snap.pooled_snapshots(stored, calendar))
    assert is_declarative(plan)
    assert exchanges(plan) == 2
    assert plan.count("FileScan") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_evaluation_is_one_chain(stored):
    calendar = snap.calendar_between(datetime(1995, 1, 1), datetime(2001, 11, 4))
    rows = snap.pooled_snapshots(stored, calendar, first_step=0, last_step=11)
    scored = rows.select(STEP, SNAPSHOT, "churn_30d", queries.stand_in_score(90).alias("p"))
    plan = plan_of(rolling_evaluation(scored, [STEP, SNAPSHOT], "p", "churn_30d", bounded=True))
    assert plan.count("FileScan") == 1 and "Join" not in plan and "CartesianProduct" not in plan


def test_activity_filter_reaches_the_scan(spark, tmp_path):
    logs.long_log(spark, SMALL).write.parquet(f"{tmp_path}/log")
    plan = plan_of(activity_filter(spark.read.parquet(f"{tmp_path}/log")))
    pushed = plan.split("PushedFilters")[1]
    assert "StringStartsWith(interaction_type,emarsys_sessions_)" in pushed and "In(interaction_type" in pushed


def test_months_are_split_by_size(stored, spark):
    dated = activity_filter(logs.long_log(spark, SMALL))
    from ebbtide.operators.activity import with_month

    assert "REBALANCE" in plan_of(with_month(dated).hint("rebalance", "event_month"))
