"""The queries once more, as plain SQL.

Everything is written in the direct form, with a filter per window, COUNT(DISTINCT) and
one join per snapshot, so that it shares no shortcut with the Spark plans.
"""

from __future__ import annotations

from ebbtide.config import (
    ACTION, BLANK_WORDS, BUCKET, CSV_MISSING, EVALUATED_SNAPSHOTS, EXTRACT_MONTHS, HORIZON, ID, KIND, PERCENTILE_BOUNDS,
    PROBABILITY, RISK, SNAPSHOT, TIME, VOCABULARY, Horizon,
)
from ebbtide.operators.features import feature_names
from ebbtide.operators.metrics import thresholds
from ebbtide.plans.queries import EXTRACT_AS_OF, REPLACED, SAMPLE, SHORT
from ebbtide.sources.sample_logs import RAW_AS_OF


def _texts(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_IS_ACTIVITY = f"({KIND} IN ({_texts(VOCABULARY.exact)}) OR starts_with({KIND}, '{VOCABULARY.prefix}'))"

_LONG = f"""
long_log AS (
  SELECT CAST(o_custkey AS VARCHAR) AS {ID}, o_orderdate AS {TIME},
    CASE o_orderstatus WHEN 'P' THEN 'order_in_progress' ELSE 'order' END AS {KIND}
  FROM orders
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), l_shipdate,
    CASE l_returnflag || l_linestatus
      WHEN 'NO' THEN 'emarsys_open' WHEN 'NF' THEN 'emarsys_click' WHEN 'AO' THEN 'emarsys_sessions_view'
      WHEN 'AF' THEN 'emarsys_sessions_cart_update' WHEN 'RO' THEN 'emarsys_soft_bounce'
      WHEN 'RF' THEN 'emarsys_sessions_unlisted' END
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
activity AS (SELECT * FROM long_log WHERE {_IS_ACTIVITY})"""

_SHORT_KIND = """CASE event_type WHEN 'view' THEN 'emarsys_sessions_view' WHEN 'click' THEN 'emarsys_click'
      WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'emarsys_unsub' WHEN 'error' THEN 'emarsys_hard_bounce' END"""

_SHORT = f"""
short_log AS (
  SELECT CAST(user_id AS VARCHAR) AS {ID}, ts AS {TIME}, {_SHORT_KIND} AS {KIND} FROM events),
activity AS (SELECT * FROM short_log WHERE {_IS_ACTIVITY})"""

_SPACE = "' ' || chr(9)"
_PARSED = (f"CASE WHEN ends_with({TIME}, '+02:00') THEN TRY_CAST(replace({TIME}, '+02:00', '') AS TIMESTAMP) - INTERVAL 2 HOUR "
           f"ELSE TRY_CAST(replace({TIME}, 'Z', '') AS TIMESTAMP) END")

_RAW = f"""
untidy AS (
  SELECT event_id % 10 AS flaw, CAST(user_id AS VARCHAR) AS u, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS t,
    {_SHORT_KIND} AS k, CAST(value AS VARCHAR) AS v, event_type FROM events),
cells AS (
  SELECT CASE flaw WHEN 1 THEN ' ' WHEN 2 THEN 'null' WHEN 3 THEN ' None' WHEN 4 THEN chr(9) || ' U' || u ELSE u END
      AS {ID},
    CASE flaw WHEN 5 THEN 'bad' WHEN 6 THEN t || 'Z' WHEN 7 THEN t || '+02:00' ELSE t END AS {TIME},
    CASE flaw WHEN 8 THEN ' ' || upper(k) || chr(9) ELSE k END AS {KIND},
    CASE flaw WHEN 9 THEN ' EMAIL ' ELSE 'web' END AS channel,
    CASE flaw WHEN 0 THEN ' NaN ' ELSE ' Shop A' END AS shop
  FROM untidy),
raw_log AS (
  SELECT {", ".join(f"CASE WHEN {c} IN ({_texts(CSV_MISSING)}) THEN NULL ELSE {c} END AS {c}"
                    for c in (ID, TIME, KIND, "channel", "shop"))}
  FROM cells),
clean AS (
  SELECT * FROM (
    SELECT trim({ID}, {_SPACE}) AS {ID}, {_PARSED} AS {TIME},
      lower(trim({KIND}, {_SPACE})) AS {KIND}, lower(trim(channel, {_SPACE})) AS channel, trim(shop, {_SPACE}) AS shop
    FROM raw_log)
  WHERE {ID} IS NOT NULL AND {TIME} IS NOT NULL AND {KIND} IS NOT NULL)"""

_LAST = "(SELECT max(event_time) FROM activity)"


def _counted(w: int, recent: str) -> list[str]:
    columns = [
        f"count(*) FILTER (WHERE {recent}) AS n_events_last_{w}d",
        f"count(DISTINCT CAST(e.{TIME} AS DATE)) FILTER (WHERE {recent}) AS active_days_last_{w}d",
    ]
    return columns + [
        f"count(*) FILTER (WHERE {recent} AND e.{KIND} = '{kind}') AS cnt_{kind}_last_{w}d" for kind in VOCABULARY.listed
    ]


def _features(horizon: Horizon, full: bool) -> str:
    """CTEs from ``snapshots(snapshot_index, snapshot_time)`` and ``activity`` to ``features``."""
    oldest = "" if full else f" AND e.{TIME} > s.{SNAPSHOT} - INTERVAL {horizon.lookback} DAY"
    counted = [c for w in horizon.windows for c in _counted(w, f"e.{TIME} > s.{SNAPSHOT} - INTERVAL {w} DAY")]
    a, b, c = horizon.windows
    sessions = " + ".join(f"cnt_{kind}_last_{a}d" for kind in VOCABULARY.sessions)
    email = f"(cnt_{VOCABULARY.opened}_last_{a}d + cnt_{VOCABULARY.clicked}_last_{a}d)"
    flags = ", ".join(f"CAST(recency_days > {d} AS INTEGER) AS inactive_{d}d" for d in horizon.inactive_flags)
    return f"""
counted AS (
  SELECT s.snapshot_index, s.{SNAPSHOT}, e.{ID},
    CAST((epoch_us(s.{SNAPSHOT}) - epoch_us(max(e.{TIME}))) // 86400000000 AS INTEGER) AS recency_days,
    {", ".join(counted)}
  FROM snapshots s JOIN activity e ON e.{TIME} <= s.{SNAPSHOT}{oldest}
  GROUP BY s.snapshot_index, s.{SNAPSHOT}, e.{ID}),
outcome AS (
  SELECT s.snapshot_index, e.{ID}, count(*) AS n_future
  FROM snapshots s JOIN activity e
    ON e.{TIME} > s.{SNAPSHOT} AND e.{TIME} <= s.{SNAPSHOT} + INTERVAL {horizon.outcome} DAY
  GROUP BY ALL),
features AS (
  SELECT c.*,
    n_events_last_{a}d / (n_events_last_{b}d + 1) AS freq_trend_{a}_{b},
    n_events_last_{b}d / (n_events_last_{c}d + 1) AS freq_trend_{b}_{c},
    active_days_last_{a}d / {a} AS active_ratio_{a}d,
    {flags}, 1 AS has_any_activity_hist,
    {sessions} AS n_session_events_last_{a}d,
    {email} AS n_email_engagement_last_{a}d,
    cnt_{VOCABULARY.ordered}_last_{a}d AS n_orders_last_{a}d,
    ({sessions}) / (n_events_last_{a}d + 1) AS session_share_{a}d,
    {email} / (n_events_last_{a}d + 1) AS email_share_{a}d,
    n_events_last_{a}d / (active_days_last_{a}d + 1) AS events_per_active_day_{a}d,
    cnt_{VOCABULARY.clicked}_last_{a}d / (cnt_{VOCABULARY.opened}_last_{a}d + 1) AS click_to_open_{a}d,
    COALESCE(o.n_future, 0) AS {horizon.future_count},
    CAST(o.n_future IS NULL AS INTEGER) AS {horizon.target}
  FROM counted c LEFT JOIN outcome o USING (snapshot_index, {ID}))"""


def _one_snapshot(time: str) -> str:
    return f"snapshots AS (SELECT 0 AS snapshot_index, {time} AS {SNAPSHOT})"


def _all_snapshots(horizon: Horizon = HORIZON) -> str:
    anchor = f"(SELECT max({TIME}) FROM activity) - INTERVAL {horizon.outcome} DAY"
    return f"""
snapshots AS (
  SELECT CAST(k AS INTEGER) AS snapshot_index, {anchor} - k * INTERVAL {horizon.step} DAY AS {SNAPSHOT}
  FROM range(0, 10000) r(k)
  WHERE {anchor} - k * INTERVAL {horizon.step} DAY
    >= (SELECT min({TIME}) FROM activity) + INTERVAL {horizon.lookback} DAY)"""


_OUTCOME_START = f"{_LAST} - INTERVAL {HORIZON.outcome} DAY"
_FEATURES = ", ".join(feature_names())
_NEWEST = f"WITH {_LONG}, {_one_snapshot(_LAST)}, {_features(HORIZON, True)}"
_TEST = f"WITH {_LONG}, {_one_snapshot(_OUTCOME_START)}, {_features(HORIZON, False)}"
_POOL = f"WITH {_LONG}, {_all_snapshots()}, {_features(HORIZON, False)}"


def _raw_score(lookback: int) -> str:
    return f"1 - active_days_last_{lookback}d / (recency_days + CAST(10.0 AS DOUBLE))"


def _score(lookback: int) -> str:
    raw = _raw_score(lookback)
    return f"floor(greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), {raw})) * 1000) / CAST(1000 AS DOUBLE)"


def _bucket(medium, high, very_high) -> str:
    p = PROBABILITY
    return (f"CASE WHEN {p} >= {very_high} THEN 'very_high' WHEN {p} >= {high} THEN 'high' "
            f"WHEN {p} >= {medium} THEN 'medium' ELSE 'low' END")


_FIXED_BUCKET = _bucket(RISK.medium, RISK.high, RISK.very_high)
_FLAG = f"CAST({BUCKET} IN ('very_high', 'high', 'weak_signal') AS INTEGER) AS {ACTION}"

_SHORT_SCORES = f"""WITH {_SHORT}, {_one_snapshot(_LAST)}, {_features(SHORT, True)},
scored AS (
  SELECT {ID}, {SNAPSHOT}, {PROBABILITY}, {_FIXED_BUCKET} AS {BUCKET}
  FROM (SELECT {ID}, {SNAPSHOT}, {_score(SHORT.lookback)} AS {PROBABILITY} FROM features)),
silent AS (
  SELECT CAST(c_custkey AS VARCHAR) AS {ID}, {_LAST} AS {SNAPSHOT}, CAST(1 AS DOUBLE) AS {PROBABILITY},
    'weak_signal' AS {BUCKET}
  FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT {ID} FROM activity)),
table_of_scores AS (SELECT * FROM scored UNION ALL SELECT * FROM silent)"""

_ALL_RATED = f"""{_POOL},
rated AS (
  SELECT snapshot_index, {SNAPSHOT}, {HORIZON.target} AS y, {_score(HORIZON.lookback)} AS p FROM features)"""
_UNROUNDED = f"""{_POOL},
rated AS (
  SELECT snapshot_index, {SNAPSHOT}, {HORIZON.target} AS y, {_raw_score(HORIZON.lookback)} AS p FROM features)"""
_EVALUATED = f"{_ALL_RATED[:-1]} WHERE snapshot_index < {EVALUATED_SNAPSHOTS})"

_CUTS = f"""
cuts AS (SELECT unnest([{", ".join(f"CAST({t!r} AS DOUBLE)" for t in thresholds())}]) AS t)"""

_SWEEP = f"""{_CUTS},
at_cut AS (
  SELECT snapshot_index, {SNAPSHOT}, t, count(*) FILTER (WHERE p >= t AND y = 1) AS tp,
    count(*) FILTER (WHERE p >= t AND y = 0) AS fp, count(*) FILTER (WHERE y = 1) AS pos, count(*) AS n
  FROM rated, cuts GROUP BY ALL),
cut_rates AS (
  SELECT *, COALESCE(2 * tp / nullif(tp + fp + pos, 0), 0) AS f1_opt, (tp + n - pos - fp) / n AS accuracy_opt,
    COALESCE(tp / nullif(tp + fp, 0), 0) AS precision_opt, COALESCE(tp / nullif(pos, 0), 0) AS recall_opt
  FROM at_cut),
best AS (
  SELECT snapshot_index, {SNAPSHOT}, t AS threshold_opt, f1_opt, accuracy_opt, precision_opt, recall_opt
  FROM cut_rates QUALIFY row_number() OVER (PARTITION BY snapshot_index ORDER BY f1_opt DESC, t) = 1)"""

_PAIRS = f"""
auc AS (
  SELECT a.snapshot_index, a.{SNAPSHOT},
    avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END) AS roc_auc
  FROM rated a JOIN rated b ON a.snapshot_index = b.snapshot_index AND a.y = 1 AND b.y = 0 GROUP BY ALL)"""

_STEPS = f"""
reached AS (
  SELECT a.snapshot_index, a.{SNAPSHOT}, a.p, a.here, count(*) FILTER (WHERE b.y = 1) AS tp, count(*) AS n
  FROM (SELECT snapshot_index, {SNAPSHOT}, p, count(*) FILTER (WHERE y = 1) AS here FROM rated GROUP BY ALL) a
  JOIN rated b ON a.snapshot_index = b.snapshot_index AND b.p >= a.p GROUP BY ALL),
ap AS (
  SELECT snapshot_index, {SNAPSHOT}, sum(here * tp / n) / nullif(sum(here), 0) AS pr_auc FROM reached GROUP BY ALL)"""

_AT_HALF = f"""
half AS (
  SELECT snapshot_index, {SNAPSHOT}, count(*) AS n_rows, avg(y) AS churn_rate,
    CAST(0.5 AS DOUBLE) AS threshold,
    avg(CAST((p >= 0.5) = (y = 1) AS INTEGER)) AS accuracy,
    COALESCE(count(*) FILTER (WHERE p >= 0.5 AND y = 1) / nullif(count(*) FILTER (WHERE p >= 0.5), 0), 0) AS "precision",
    COALESCE(count(*) FILTER (WHERE p >= 0.5 AND y = 1) / nullif(count(*) FILTER (WHERE y = 1), 0), 0) AS recall,
    COALESCE(2 * count(*) FILTER (WHERE p >= 0.5 AND y = 1)
      / nullif(count(*) FILTER (WHERE p >= 0.5) + count(*) FILTER (WHERE y = 1), 0), 0) AS f1
  FROM rated GROUP BY ALL)"""


def _matrix(transform: str) -> str:
    prefixes = ("n_events_last_", "active_days_last_", "cnt_", "n_session_events_", "n_email_engagement_", "n_orders_")
    cells = []
    for name in feature_names():
        if name == "recency_days":
            cell = f"least(CAST({name} AS DOUBLE), 365)"
        elif transform == "log1p" and name.startswith(prefixes):
            cell = f"ln(1 + CAST({name} AS DOUBLE))"
        else:
            cell = f"CAST({name} AS DOUBLE)"
        cells.append(f"{cell} AS {name}")
    return ", ".join(cells)


def _quality_stage(stage: str, source: str, before: str, columns: str) -> str:
    return f"""SELECT '{stage}' AS stage, (SELECT count(*) FROM {before}) AS rows_before, count(*) AS rows_after,
    (SELECT count(*) FROM {before}) - count(*) AS rows_dropped, min({TIME}) AS first_event, max({TIME}) AS last_event,
    count(DISTINCT {ID}) AS n_customers, count(DISTINCT strftime({TIME}, '%Y-%m')) AS n_months, '{columns}' AS columns
  FROM {source}"""


_CORE = f"{ID}, {TIME}, {KIND}"
_MONTH = f"strftime({TIME}, '%Y-%m') AS event_month"
_WINDOW = (f"{TIME} > {_OUTCOME_START} - INTERVAL {HORIZON.lookback} DAY AND {TIME} <= {_LAST}")
_DRAWN = f"SELECT DISTINCT {ID} FROM long_log ORDER BY md5({ID} || ':42'), {ID} LIMIT {SAMPLE}"


#: What a stream of the short log has closed at its end, to the millisecond.
_WATERMARK = f"(SELECT date_trunc('millisecond', max({TIME})) - INTERVAL 2 DAY FROM activity)"
_DAY_FIRST = f"""
written AS (
  SELECT event_id % 10 AS flaw, CAST(user_id AS VARCHAR) AS {ID}, ts, {_SHORT_KIND} AS {KIND} FROM events)"""
_BROKEN = f"""
lines AS (
  SELECT event_id % 10 AS flaw, CAST(user_id AS VARCHAR) AS {ID}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS {TIME}, {_SHORT_KIND} AS {KIND}
  FROM events)"""


def _strict() -> str:
    def words(c: str, lower: bool = True) -> str:
        text = f"lower(trim({c}, {_SPACE}))"
        return f"CASE WHEN {text} IN ({_texts(BLANK_WORDS)}) THEN NULL ELSE {text} END AS {c}"

    columns = ", ".join(words(c) for c in (ID, KIND, "channel", "shop"))
    return f"""WITH {_RAW}
SELECT * FROM (SELECT {columns}, {_PARSED} AS {TIME} FROM raw_log)
WHERE {ID} IS NOT NULL AND {TIME} IS NOT NULL AND {KIND} IS NOT NULL AND channel IS NOT NULL AND shop IS NOT NULL
  AND {TIME} <= TIMESTAMP '{RAW_AS_OF}'"""


def all_sql() -> dict[str, str]:
    def newest(columns: str) -> str:
        return f"{_NEWEST} SELECT {ID}, {columns} FROM features"

    windows = HORIZON.windows
    mix = ", ".join(f"cnt_{kind}_last_{w}d" for w in windows for kind in VOCABULARY.listed)
    target = HORIZON.target
    per_snapshot = f"snapshot_index, {SNAPSHOT}"
    activity = f"WITH {_LONG}"
    stages = " UNION ALL ".join([
        _quality_stage("clean", "clean", "raw_log", f"{_CORE}, channel, shop"),
        _quality_stage("activity", "active", "clean", f"{_CORE}, channel, shop"),
        _quality_stage("month", "active", "active", f"{_CORE}, event_month"),
    ])
    spread = ", ".join(f"stddev_samp({n}) AS {n}" for n in feature_names())
    low, mid, top = PERCENTILE_BOUNDS
    return {
        "clean_events": f"WITH {_RAW} SELECT * FROM clean",
        "clean_events_strict": _strict(),
        "clean_day_first": f"WITH {_DAY_FIRST} SELECT {ID}, CASE flaw WHEN 3 THEN date_trunc('minute', ts) WHEN 4 THEN date_trunc('day', ts) "
                           f"ELSE date_trunc('second', ts) END::TIMESTAMP AS {TIME}, {KIND} FROM written WHERE flaw NOT IN (1, 2)",
        "day_order": f"WITH {_DAY_FIRST} SELECT count(*) FILTER (day(ts) > 12) AS day_first_times, 0::BIGINT AS month_first_times, "
                     f"count(*) FILTER (day(ts) <= 12 AND day(ts) <> month(ts)) AS ambiguous_times, true AS day_first "
                     f"FROM written WHERE flaw NOT IN (1, 2, 4)",
        "csv_round_trip": f"WITH {_RAW} SELECT * FROM clean",
        "quarantined_rows": f"WITH {_BROKEN} SELECT malformed_record, count(*) AS n_rows FROM ("
                            f"SELECT {ID} || ',' || {TIME} || ',' || {KIND} || ',web' AS malformed_record FROM lines WHERE flaw = 1 "
                            f"UNION ALL SELECT {ID} || ',on' FROM lines WHERE flaw = 2 "
                            f"UNION ALL SELECT {TIME} || ',' || {KIND} FROM lines WHERE flaw = 2) GROUP BY malformed_record",
        "unbroken_rows": f"WITH {_BROKEN} SELECT {_CORE} FROM lines WHERE flaw NOT IN (1, 2)",
        "bucketed_features": newest(_FEATURES),
        "bucketed_weak_signal": f"{_SHORT_SCORES} SELECT *, 1 AS {ACTION} FROM silent",
        "stream_activity": f"WITH {_RAW} SELECT {_CORE} FROM clean WHERE {_IS_ACTIVITY}",
        "stream_daily_counts": f"WITH {_SHORT} SELECT CAST({TIME} AS DATE) AS day, {ID}, count(*) AS n_events FROM activity "
                               f"WHERE CAST({TIME} AS DATE) + INTERVAL 1 DAY <= {_WATERMARK} GROUP BY ALL",
        "stream_sliding_counts": f"WITH {_SHORT} SELECT CAST(d AS DATE) AS last_day, {ID}, count(*) AS n_events FROM activity, "
                                 f"LATERAL (SELECT unnest(generate_series(CAST({TIME} AS DATE), CAST({TIME} AS DATE) + "
                                 f"INTERVAL {SHORT.windows[0] - 1} DAY, INTERVAL 1 DAY)) AS d) "
                                 f"WHERE d + INTERVAL 1 DAY <= {_WATERMARK} GROUP BY ALL",
        "stream_inactivity": f"""WITH {_SHORT}, gaps AS (
  SELECT *, lag({TIME}) OVER w IS NULL OR lag({TIME}) OVER w + INTERVAL {SHORT.inactive_flags[0]} DAY < {TIME} AS opens
  FROM activity WINDOW w AS (PARTITION BY {ID} ORDER BY {TIME})),
spells AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY {ID} ORDER BY {TIME}) AS spell FROM gaps)
SELECT {ID}, min({TIME}) AS first_event, max({TIME}) AS last_event, max({TIME}) + INTERVAL {SHORT.inactive_flags[0]} DAY AS inactive_from,
  count(*) AS n_events FROM spells GROUP BY {ID}, spell
HAVING max({TIME}) + INTERVAL {SHORT.inactive_flags[0]} DAY <= {_WATERMARK}""",
        "month_dataset_window": f"{activity} SELECT {_CORE} FROM activity WHERE {_WINDOW}",
        "replaced_month": f"{activity} SELECT {_CORE} FROM activity WHERE {TIME} > DATE '{REPLACED[0]}' - INTERVAL 40 DAY "
                          f"AND {TIME} <= DATE '{REPLACED[0]}' + INTERVAL 60 DAY "
                          f"AND ({KIND} = 'order' OR CAST({TIME} AS DATE) NOT BETWEEN DATE '{REPLACED[0]}' AND DATE '{REPLACED[1]}')",
        "incremental_features": newest(_FEATURES),
        "incremental_snapshots": f"{_POOL} SELECT {per_snapshot}, {ID}, {_FEATURES}, {target} FROM features WHERE snapshot_index > 0",
        "data_quality": f"WITH {_RAW}, active AS (SELECT * FROM clean WHERE {_IS_ACTIVITY}) {stages}",
        "time_range": f"{activity} SELECT min({TIME}) AS first_event, max({TIME}) AS last_event FROM activity",
        "activity_filter": f"{activity} SELECT {_CORE} FROM activity",
        "event_counts": f"{activity} SELECT {KIND}, count(*) AS n_rows, "
                        f"count(*) / (SELECT count(*) FROM activity) AS share FROM activity GROUP BY {KIND}",
        "month_partitions": f"{activity} SELECT {_MONTH}, count(*) AS n_rows, min({TIME}) AS first_event, "
                            f"max({TIME}) AS last_event FROM activity GROUP BY ALL ORDER BY event_month",
        "months_in_range": f"{activity} SELECT strftime(m, '%Y-%m') AS event_month FROM (SELECT unnest(generate_series("
                           f"date_trunc('month', min({TIME})), date_trunc('month', max({TIME})), INTERVAL 1 MONTH)) AS m "
                           f"FROM activity)",
        "load_events_window": f"{activity} SELECT {_CORE} FROM activity WHERE {_WINDOW}",
        "window_slice": f"WITH {_SHORT} SELECT {_CORE} FROM activity WHERE {TIME} <= {_LAST} - INTERVAL {SHORT.outcome} DAY "
                        f"AND {TIME} > {_LAST} - INTERVAL {SHORT.outcome + SHORT.lookback} DAY",
        "extract_recent_incoming": f"""SELECT * FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS {ID}, l_shipdate AS {TIME}, l_linestatus AS {KIND},
    CASE WHEN l_returnflag = 'R' THEN 'outgoing' ELSE 'incoming' END AS incoming_outgoing FROM lineitem)
WHERE {TIME} >= DATE '{EXTRACT_AS_OF}' - INTERVAL {EXTRACT_MONTHS} MONTH AND incoming_outgoing = 'incoming'""",
        "sampled_customers": f"{activity} {_DRAWN}",
        "sampled_customer_events": f"{activity}, drawn AS ({_DRAWN}) SELECT {_CORE} FROM long_log "
                                   f"WHERE {ID} IN (SELECT {ID} FROM drawn)",
        "customer_recency": f"WITH {_SHORT} SELECT {ID}, max({TIME}) AS last_event_time, "
                            f"CAST(date_sub('day', max({TIME}), {_LAST}) AS INTEGER) AS recency_days "
                            f"FROM activity GROUP BY {ID}",
        "event_frequency": newest(", ".join(f"n_events_last_{w}d" for w in windows)),
        "active_days": newest(", ".join(f"active_days_last_{w}d" for w in windows)),
        "event_mix": newest(mix),
        "trend_features": newest("freq_trend_30_60, freq_trend_60_90, active_ratio_30d"),
        "family_ratios": newest("n_session_events_last_30d, n_email_engagement_last_30d, n_orders_last_30d, "
                                "session_share_30d, email_share_30d, events_per_active_day_30d, click_to_open_30d"),
        "customer_features": newest(_FEATURES),
        "customer_features_short": f"WITH {_SHORT}, {_one_snapshot(f'{_LAST} - INTERVAL {SHORT.outcome} DAY')}, "
                                   f"{_features(SHORT, True)} SELECT {ID}, {', '.join(feature_names(SHORT))} FROM features",
        "inactivity_label": f"{_TEST} SELECT {ID}, {target} FROM features",
        "labelled_counts": f"WITH {_LONG}, {_one_snapshot(_OUTCOME_START)}, {_features(HORIZON, True)} "
                           f"SELECT {ID}, {_FEATURES}, {HORIZON.future_count}, {target}, {SNAPSHOT}, "
                           f"{SNAPSHOT} + INTERVAL {HORIZON.outcome} DAY AS window_end FROM features",
        "labelled_snapshot": f"{_TEST} SELECT {ID}, {_FEATURES}, {target} FROM features",
        "snapshot_calendar": f"WITH {_LONG}, {_all_snapshots()} SELECT {per_snapshot}, "
                             f"{SNAPSHOT} - INTERVAL {HORIZON.lookback} DAY AS lookback_start, "
                             f"{SNAPSHOT} + INTERVAL {HORIZON.outcome} DAY AS outcome_end FROM snapshots",
        "pooled_snapshots": f"{_POOL} SELECT {per_snapshot}, {ID}, {_FEATURES}, {target} FROM features "
                            f"WHERE snapshot_index > 0",
        "pooled_snapshots_short": f"WITH {_SHORT}, {_all_snapshots(SHORT)}, {_features(SHORT, False)} "
                                  f"SELECT {per_snapshot}, {ID}, {', '.join(feature_names(SHORT))}, {SHORT.target} "
                                  f"FROM features",
        "snapshot_summary": f"{_POOL} SELECT {per_snapshot}, count(*) AS n_rows, avg({target}) AS churn_rate "
                            f"FROM features GROUP BY ALL ORDER BY snapshot_index",
        "class_weights": f"{_POOL} SELECT {target}, count(*) AS n_rows, (SELECT count(*) FROM features "
                         f"WHERE snapshot_index > 0) / CAST(2 AS DOUBLE) / count(*) AS weight FROM features "
                         f"WHERE snapshot_index > 0 GROUP BY {target}",
        "feature_matrix": f"{_TEST} SELECT {ID}, {_matrix('none')} FROM features",
        "feature_matrix_log1p": f"{_TEST}, matrix AS (SELECT {ID}, {_matrix('log1p')} FROM features) SELECT {ID}, "
                                + ", ".join(f"round({n}, 9) AS {n}" for n in feature_names()) + " FROM matrix",
        "constant_features": f"{_POOL}, matrix AS (SELECT {_matrix('log1p')} FROM features WHERE snapshot_index > 0), "
                             f"spread AS (SELECT {spread} FROM matrix) SELECT feature, round(deviation, 9) AS deviation, "
                             f"CAST(deviation = 0 AS INTEGER) AS is_constant "
                             f"FROM (UNPIVOT spread ON {_FEATURES} INTO NAME feature VALUE deviation)",
        "risk_buckets": f"{_NEWEST} SELECT *, {_FLAG} FROM (SELECT *, {_FIXED_BUCKET} AS {BUCKET} FROM (SELECT {ID}, "
                        f"{_score(HORIZON.lookback)} AS {PROBABILITY} FROM features))",
        "percentile_buckets": f"""{_NEWEST},
scored AS (SELECT {ID}, {SNAPSHOT}, {_score(HORIZON.lookback)} AS {PROBABILITY} FROM features),
cuts AS (SELECT quantile_cont({PROBABILITY}, {low}) AS p40, quantile_cont({PROBABILITY}, {mid}) AS p70,
  quantile_cont({PROBABILITY}, {top}) AS p90 FROM scored)
SELECT *, {_FLAG} FROM (
  SELECT {ID}, {SNAPSHOT}, {PROBABILITY}, {_bucket('p40', 'p70', 'p90')} AS {BUCKET} FROM scored, cuts)""",
        "recency_distribution": f"{_NEWEST} SELECT min(recency_days) AS min_recency, max(recency_days) AS max_recency, "
                                f"median(recency_days) AS median_recency, "
                                f"count(*) FILTER (WHERE recency_days <= 90) AS n_active, "
                                f"count(*) FILTER (WHERE recency_days > 90) AS n_dormant, count(*) AS n_customers "
                                f"FROM features",
        "weak_signal": f"{_SHORT_SCORES} SELECT *, 1 AS {ACTION} FROM silent",
        "score_table": f"{_SHORT_SCORES} SELECT *, {_FLAG} FROM table_of_scores",
        "bucket_distribution": f"{_SHORT_SCORES} SELECT {BUCKET}, count(*) AS n_rows, "
                               f"count(*) / (SELECT count(*) FROM table_of_scores) AS share, "
                               f"CASE WHEN {BUCKET} <> 'weak_signal' THEN count(*) / (SELECT count(*) FROM scored) END "
                               f"AS scored_share FROM table_of_scores GROUP BY {BUCKET}",
        "classification_metrics": f"{_ALL_RATED}, {_AT_HALF} SELECT * EXCLUDE (churn_rate) FROM half",
        "roc_auc": f"{_ALL_RATED}, {_PAIRS} SELECT {per_snapshot}, round(roc_auc, 9) AS roc_auc FROM auc",
        "average_precision": f"{_ALL_RATED}, {_STEPS} SELECT {per_snapshot}, round(pr_auc, 9) AS pr_auc FROM ap",
        "roc_auc_unrounded": f"{_UNROUNDED}, {_PAIRS} SELECT {per_snapshot}, round(roc_auc, 9) AS roc_auc FROM auc",
        "average_precision_unrounded": f"{_UNROUNDED}, {_STEPS} SELECT {per_snapshot}, round(pr_auc, 9) AS pr_auc FROM ap",
        "f1_threshold_sweep": f"{_ALL_RATED}, {_SWEEP} SELECT * FROM best",
        "rolling_eval": f"{_EVALUATED}, {_SWEEP}, {_PAIRS}, {_STEPS}, {_AT_HALF} SELECT h.*, b.threshold_opt, "
                        f"b.accuracy_opt, b.precision_opt, b.recall_opt, b.f1_opt, round(roc_auc, 9) AS roc_auc, "
                        f"round(pr_auc, 9) AS pr_auc, CAST(h.snapshot_index > 0 AS INTEGER) AS in_sample FROM half h "
                        f"JOIN best b USING (snapshot_index) JOIN auc USING (snapshot_index) JOIN ap USING (snapshot_index) "
                        f"ORDER BY h.{SNAPSHOT} DESC",
        "run_metadata": f"""{_POOL} SELECT {_LAST} AS max_time, (SELECT min({TIME}) FROM activity) AS min_time,
  {_OUTCOME_START} AS snap_test, count(*) FILTER (WHERE snapshot_index > 0) AS train_rows,
  count(*) FILTER (WHERE snapshot_index = 0) AS test_rows,
  avg({target}) FILTER (WHERE snapshot_index > 0) AS train_churn_rate,
  avg({target}) FILTER (WHERE snapshot_index = 0) AS test_churn_rate, {len(feature_names())} AS n_features,
  count(DISTINCT snapshot_index) FILTER (WHERE snapshot_index > 0) AS n_train_snapshots,
  {HORIZON.step} AS rolling_step_days, {HORIZON.lookback} AS lookback_days, {HORIZON.outcome} AS churn_window_days
FROM features""",
    }
