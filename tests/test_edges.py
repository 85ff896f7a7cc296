"""Hand-made rows at the edges of windows, texts and scores. T is 2024-03-31 12:00 UTC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ebbtide.config import BUCKET, EARLIER_POOL_SIZE, HORIZON, ID, KIND, PROBABILITY, TIME, Horizon
from ebbtide.functions.clock import age_days, as_instant, instant
from ebbtide.functions.text import WHITE_SPACE, strip
from ebbtide.operators.activity import activity_filter
from ebbtide.operators.clean import STRICT, clean_events, csv_missing_to_null, normalise_log
from ebbtide.operators.features import customer_features, feature_names, snapshot_features
from ebbtide.operators.scoring import score_table, weak_signal, with_buckets
from ebbtide.operators.snapshots import calendar_between, labelled_snapshot

T = datetime(2024, 3, 31, 12)
DAY = timedelta(days=1)
MICRO = timedelta(microseconds=1)


def log_of(spark, rows):
    text = [(k, t.isoformat(sep=" "), e) for k, t, e in rows]
    raw = spark.createDataFrame(text, f"{ID} string, {TIME} string, {KIND} string")
    return raw.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


def by_id(df):
    return {row[ID]: row for row in df.collect()}


def test_window_edges(spark):
    rows = [
        ("at", T, "order"),
        ("edge30", T - 30 * DAY, "order"),
        ("inside30", T - 30 * DAY + MICRO, "order"),
        ("edge90", T - 90 * DAY, "order"),
        ("old", T - 400 * DAY, "order"),
        ("later", T + MICRO, "order"),
    ]
    got = by_id(customer_features(log_of(spark, rows), T))
    assert set(got) == {"at", "edge30", "inside30", "edge90", "old"}
    assert (got["at"]["recency_days"], got["at"]["n_events_last_30d"]) == (0, 1)
    assert (got["edge30"]["recency_days"], got["edge30"]["n_events_last_30d"], got["edge30"]["n_events_last_60d"]) == (30, 0, 1)
    assert (got["inside30"]["recency_days"], got["inside30"]["n_events_last_30d"]) == (29, 1)
    assert (got["edge90"]["recency_days"], got["edge90"]["n_events_last_90d"]) == (90, 0)
    assert (got["old"]["recency_days"], got["old"]["inactive_30d"], got["old"]["has_any_activity_hist"]) == (400, 1, 1)


def test_lookback_history_leaves_out_the_long_gone(spark):
    rows = [("near", T - 89 * DAY, "order"), ("edge", T - 90 * DAY, "order")]
    assert set(by_id(customer_features(log_of(spark, rows), T, history="lookback"))) == {"near"}


def test_outcome_edges(spark):
    rows = [(k, T - DAY, "order") for k in ("end", "past", "just_after", "none")]
    rows += [("end", T + 30 * DAY, "order"), ("past", T + 30 * DAY + MICRO, "order"), ("just_after", T + MICRO, "order")]
    got = by_id(labelled_snapshot(log_of(spark, rows), T))
    assert {k: r["churn_30d"] for k, r in got.items()} == {"end": 0, "past": 1, "just_after": 0, "none": 1}
    assert all(r["n_events_last_30d"] == 1 for r in got.values())


def test_active_days_count_calendar_dates(spark):
    rows = [("two_ends", T - timedelta(hours=1), "order"), ("two_ends", T - timedelta(hours=11), "order")]
    rows += [("each_date", T - timedelta(hours=12) - d * DAY + timedelta(hours=6), "order") for d in range(30)]
    rows += [("each_date", T - 30 * DAY + timedelta(hours=6), "order")]
    got = by_id(customer_features(log_of(spark, rows), T))
    assert got["two_ends"]["active_days_last_30d"] == 1
    assert got["each_date"]["active_days_last_30d"] == 31
    assert got["each_date"]["active_ratio_30d"] > 1


def test_both_parts_of_a_date_are_one_active_day(spark):
    day = T - 40 * DAY
    rows = [("x", day.replace(hour=11), "order"), ("x", day.replace(hour=13), "order")]
    row = by_id(customer_features(log_of(spark, rows), T))["x"]
    assert (row["active_days_last_60d"], row["n_events_last_60d"], row["recency_days"]) == (1, 2, 39)


def test_unlisted_session_counts_as_event_only(spark):
    log = log_of(spark, [("x", T, "emarsys_sessions_x"), ("x", T, "emarsys_soft_bounce"), ("x", T, None)])
    row = by_id(customer_features(activity_filter(log), T))["x"]
    assert row["n_events_last_30d"] == 1
    assert sum(v for c, v in row.asDict().items() if c.startswith("cnt_")) == 0


def test_feature_order():
    names = feature_names()
    assert len(names) == 53
    assert names[:4] == ["recency_days", "n_events_last_30d", "active_days_last_30d", "cnt_emarsys_open_last_30d"]
    assert names[40:46] == ["freq_trend_30_60", "freq_trend_60_90", "active_ratio_30d", "inactive_14d", "inactive_30d",
                            "has_any_activity_hist"]
    assert names[-1] == "click_to_open_30d"


def test_age_of_any_moment(spark):
    moments = [T, T + MICRO, T - DAY, T - DAY + MICRO, T - DAY - MICRO, T + 3 * DAY, T - 59 * DAY - timedelta(hours=13)]
    for anchor in (T, datetime(2024, 3, 31), datetime(2024, 3, 31, 23, 59, 59, 999999)):
        log = log_of(spark, [(str(i), m, "order") for i, m in enumerate(moments)])
        got = {r[ID]: r["age"] for r in log.select(ID, age_days(F.col(TIME), anchor).alias("age")).collect()}
        assert got == {str(i): (anchor - m) // DAY for i, m in enumerate(moments)}


def test_times_as_text(spark):
    texts = {
        "2024-01-01T10:00:00+02:00": datetime(2024, 1, 1, 8),
        "2024-01-01 10:00:00 UTC": datetime(2024, 1, 1, 10),
        "2024-01-01T10:00:00.5Z": datetime(2024, 1, 1, 10, 0, 0, 500000),
        "2024-03-10 02:30:00": datetime(2024, 3, 10, 2, 30),
        "2024-01-01": datetime(2024, 1, 1),
        "bad": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["m"] for r in df.select("t", as_instant(F.col("t"), df.schema["t"].dataType).alias("m")).collect()}
    assert got == texts


def test_zoned_column_becomes_utc(spark):
    moment = datetime(2024, 3, 10, 7, 30, tzinfo=timezone.utc)
    df = spark.createDataFrame([("a", moment, " ORDER ")], f"{ID} string, {TIME} timestamp, {KIND} string")
    row = normalise_log(df).first()
    assert (row[TIME], row[KIND]) == (moment.replace(tzinfo=None), "order")


def test_strip_knows_all_white_space(spark):
    assert len(WHITE_SPACE) == len(set(WHITE_SPACE)) and all(c.isspace() for c in WHITE_SPACE)
    everything = {chr(i) for i in range(0x3001) if chr(i).isspace()}
    assert set(WHITE_SPACE) == everything
    df = spark.createDataFrame([("".join(sorted(everything)) + "a b　",)], "t string")
    assert df.select(strip(F.col("t")).alias("t")).first()["t"] == "a b"


def raw_rows(spark, rows):
    columns = f"{ID} string, {TIME} string, {KIND} string, channel string, shop string, amount string"
    return spark.createDataFrame(rows, columns)


def test_lenient_keeps_blank_ids_and_future_rows(spark):
    rows = [("  ", "2024-01-01", "Order ", " WEB", " S ", "1"), (None, "2024-01-01", "order", "w", "s", "1"),
            ("A", "2999-01-01", "order", None, None, "1"), ("B", "bad", "order", "w", "s", "1")]
    got = clean_events(raw_rows(spark, rows))
    assert got.columns == [ID, TIME, KIND, "channel", "shop"]
    assert sorted((r[ID], r[KIND], r["channel"], r["shop"]) for r in got.collect()) == [
        ("", "order", "web", "S"), ("A", "order", None, None)]


def test_strict_drops_blanks_and_future_rows(spark):
    rows = [("  ", "2024-01-01", "order", "w", "s", "1"), (" None", "2024-01-01", "order", "w", "s", "1"),
            ("A", "2999-01-01", "order", "w", "s", "1"), ("B", "2024-01-01", "order", "w", None, "1"),
            ("Cc", "2024-01-01", "ORDER", "W", "S", "1")]
    raw = raw_rows(spark, rows).withColumnRenamed(KIND, KIND.upper())
    got = clean_events(raw, STRICT, as_of=T).collect()
    assert [(r[ID], r[KIND], r["shop"]) for r in got] == [("cc", "order", "s")]
    assert "amount" not in got[0].asDict()
    assert clean_events(raw, STRICT).count() == 1


def test_csv_words_mean_missing_only_when_exact(spark):
    df = spark.createDataFrame([("null",), (" null",), ("NaN",), ("NONE",)], "t string")
    assert [r["t"] for r in csv_missing_to_null(df).collect()] == [None, " null", None, "NONE"]


def test_missing_columns_are_reported_at_once(spark):
    with pytest.raises(ValueError, match="event_time"):
        clean_events(spark.createDataFrame([("a", "b")], f"{ID} string, {KIND} string"))
    with pytest.raises(ValueError, match="interaction_type"):
        normalise_log(spark.createDataFrame([("a", "b")], f"{ID} string, {TIME} string"))


def test_buckets_at_the_thresholds(spark):
    values = [0.8, 0.6, 0.4, 0.39999, float("nan"), 1.0, 0.0, None]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], f"{ID} string, {PROBABILITY} double")
    rows = sorted(with_buckets(df).collect(), key=lambda r: int(r[ID]))
    assert [r[BUCKET] for r in rows] == ["very_high", "high", "medium", "low", "low", "very_high", "low", "low"]
    assert [r["churn_action"] for r in rows] == [1, 1, 0, 0, 0, 1, 0, 0]


def test_weak_signal_is_never_active(spark):
    cleaned = log_of(spark, [("a ", T, "order"), ("b", T, "emarsys_soft_bounce"), ("b", T, "emarsys_unsub")])
    activity = activity_filter(cleaned)
    silent = weak_signal(cleaned, activity, T)
    scored = spark.createDataFrame([("a", 0.1)], f"{ID} string, {PROBABILITY} double")
    got = by_id(score_table(scored, silent, T))
    assert {k: (r[PROBABILITY], r[BUCKET], r["churn_action"]) for k, r in got.items()} == {
        "a": (0.1, "low", 0), "b": (1.0, "weak_signal", 1)}


def test_calendar_of_the_published_run():
    calendar = calendar_between(datetime(2023, 2, 1, 0, 0, 5, tzinfo=timezone.utc),
                                datetime(2026, 1, 31, 2, 59, 54, tzinfo=timezone.utc))
    assert calendar.anchor == datetime(2026, 1, 1, 2, 59, 54)
    assert calendar.pooled == 32
    assert calendar_between(calendar.first_event, calendar.last_event, limit=EARLIER_POOL_SIZE).pooled == 4
    assert calendar_between(T, T + 100 * DAY).pooled == 0


def test_bad_arguments_are_refused(spark):
    log = log_of(spark, [("x", T, "order")])
    with pytest.raises(ValueError):
        snapshot_features(log, T, history="some")
    with pytest.raises(ValueError):
        snapshot_features(log, T, history="full", last_step=2)
    with pytest.raises(ValueError):
        Horizon(windows=(30, 20, 10))
    with pytest.raises(ValueError):
        Horizon(windows=(30, 60, 120))
    assert instant(T) is not None and HORIZON.target == "churn_30d"
