"""The one-pass features equal a direct count per snapshot and customer, on random logs."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide.config import HORIZON, ID, KIND, TIME, VOCABULARY, Horizon
from ebbtide.operators.activity import customers_of
from ebbtide.operators.features import STEP, feature_names, snapshot_features
from ebbtide.operators.sampling import sampled_customers
from ebbtide.operators.snapshots import calendar_between

DAY = timedelta(days=1)
KINDS = (*VOCABULARY.listed, "emarsys_sessions_x")


def random_log(seed: int, n: int, span: int, customers: int):
    """A third of all rows belong to one customer."""
    rng = random.Random(seed)
    start = datetime(2023, 1, 1, rng.randrange(24), 30)
    rows = []
    for _ in range(n):
        customer = "busy" if rng.random() < 1 / 3 else f"c{rng.randrange(customers)}"
        # Half of the times lie on whole days from the start, so that edges are met exactly.
        offset = timedelta(days=rng.randrange(span)) if rng.random() < 0.5 else timedelta(seconds=rng.random() * span * 86400)
        rows.append((customer, start + offset, rng.choice(KINDS)))
    return rows


def expected(rows, snapshot, horizon, full):
    known = {}
    for customer, time, kind in rows:
        if time <= snapshot and (full or time > snapshot - horizon.lookback * DAY):
            known.setdefault(customer, []).append((time, kind))
    out = {}
    for customer, events in known.items():
        row = {"recency_days": (snapshot - max(t for t, _ in events)) // DAY}
        for w in horizon.windows:
            inside = [(t, k) for t, k in events if t > snapshot - w * DAY]
            kinds = Counter(k for _, k in inside)
            row[f"n_events_last_{w}d"] = len(inside)
            row[f"active_days_last_{w}d"] = len({t.date() for t, _ in inside})
            row |= {f"cnt_{k}_last_{w}d": kinds[k] for k in VOCABULARY.listed}
        a, b, c = horizon.windows
        n = {w: row[f"n_events_last_{w}d"] for w in horizon.windows}
        days, opens, clicks = row[f"active_days_last_{a}d"], row[f"cnt_emarsys_open_last_{a}d"], row[f"cnt_emarsys_click_last_{a}d"]
        sessions = sum(row[f"cnt_{k}_last_{a}d"] for k in VOCABULARY.sessions)
        row |= {
            f"freq_trend_{a}_{b}": n[a] / (n[b] + 1), f"freq_trend_{b}_{c}": n[b] / (n[c] + 1),
            f"active_ratio_{a}d": days / a, "has_any_activity_hist": 1,
            f"n_session_events_last_{a}d": sessions, f"n_email_engagement_last_{a}d": opens + clicks,
            f"n_orders_last_{a}d": row[f"cnt_order_last_{a}d"], f"session_share_{a}d": sessions / (n[a] + 1),
            f"email_share_{a}d": (opens + clicks) / (n[a] + 1), f"events_per_active_day_{a}d": n[a] / (days + 1),
            f"click_to_open_{a}d": clicks / (opens + 1),
        }
        row |= {f"inactive_{d}d": int(row["recency_days"] > d) for d in horizon.inactive_flags}
        row[horizon.future_count] = sum(
            1 for k, t, _ in rows if k == customer and snapshot < t <= snapshot + horizon.outcome * DAY
        )
        row[horizon.target] = int(row[horizon.future_count] == 0)
        out[customer] = row
    return out


def as_frame(spark, rows):
    text = [(k, t.isoformat(sep=" "), e) for k, t, e in rows]
    return spark.createDataFrame(text, f"{ID} string, {TIME} string, {KIND} string").withColumn(
        TIME, F.col(TIME).cast("timestamp_ntz")
    )


HORIZONS = [
    (1, HORIZON, 400),
    (2, Horizon(windows=(3, 6, 9), lookback=9, outcome=1, step=3), 40),
    (3, Horizon(windows=(2, 5, 7), lookback=11, outcome=4, step=3, inactive_flags=(1, 2)), 45),
    (4, Horizon(windows=(1, 2, 3), lookback=3, outcome=8, step=5), 60),
]


@pytest.mark.parametrize("seed,horizon,span", HORIZONS)
def test_pooled_snapshots_equal_the_direct_form(spark, seed, horizon, span):
    rows = random_log(seed, 900, span, 12)
    calendar = calendar_between(min(t for _, t, _ in rows), max(t for _, t, _ in rows), horizon)
    assert calendar.pooled >= 3
    df = snapshot_features(as_frame(spark, rows), calendar.anchor, horizon, last_step=calendar.pooled)
    got = {(r[STEP], r[ID]): r.asDict() for r in df.collect()}
    names = [*feature_names(horizon), horizon.future_count, horizon.target]
    wanted = {}
    for k in range(calendar.pooled + 1):
        snapshot = calendar.anchor - k * horizon.step * DAY
        for customer, row in expected(rows, snapshot, horizon, full=False).items():
            wanted[k, customer] = row | {"snapshot_time": snapshot}
    assert set(got) == set(wanted)
    for key, row in wanted.items():
        assert {c: got[key][c] for c in [*names, "snapshot_time"]} == {c: row[c] for c in [*names, "snapshot_time"]}, key


@pytest.mark.parametrize("seed", [5, 6])
def test_full_history_equals_the_direct_form(spark, seed):
    rows = random_log(seed, 600, 300, 15)
    snapshot = sorted(t for _, t, _ in rows)[450]
    df = snapshot_features(as_frame(spark, rows), snapshot, history="full")
    got = {r[ID]: r.asDict() for r in df.collect()}
    wanted = expected(rows, snapshot, HORIZON, full=True)
    assert set(got) == set(wanted)
    for customer, row in wanted.items():
        assert {c: got[customer][c] for c in row} == row


def test_sample_is_repeatable_and_complete(spark):
    log = as_frame(spark, random_log(7, 800, 30, 200))
    everyone = {r[ID] for r in customers_of(log).collect()}
    drawn = [r[ID] for r in sampled_customers(log, 50).collect()]
    assert len(set(drawn)) == 50 and set(drawn) <= everyone
    assert drawn == [r[ID] for r in sampled_customers(log.repartition(7), 50).collect()]
    assert drawn != [r[ID] for r in sampled_customers(log, 50, seed=1).collect()]
    assert {r[ID] for r in sampled_customers(log, 10_000).collect()} == everyone
