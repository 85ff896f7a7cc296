"""Customer features at one or many snapshot times, in one pass over the log.

Four steps replace a scan, a join and a distinct count per window and snapshot:

1. ``event_tallies``: rows are counted per customer, calendar date and kind. This
   combines before the shuffle, its rows are narrow, and a busy customer is spread
   over as many groups as they have dates and kinds. A snapshot's 24-hour days end at
   its time of day, so a date has two parts of different age, which are kept apart.
2. The tallies, a bounded number per customer, are brought together by customer.
   Nothing after this step shuffles.
3. ``daily_counts``: one wide row per customer and date.
4. Each daily row is copied to the snapshots it can matter to (a handful, however many
   snapshots there are) and summed per snapshot and customer. A daily row is one date,
   so active days are a plain count of rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import (
    HORIZON, ID, KIND, RECENCY_UNKNOWN, SNAPSHOT, TIME, VOCABULARY, Horizon, Vocabulary,
)
from ebbtide.functions.clock import age_days, day_offset, days, instant

STEP = "snapshot_index"
OFFSET = "day_offset"
LATE = "is_late"
EVERYTHING = "all"
OLD_AGE = "old_age"
RECENT_AGE = "recent_age"
PARTS = ("late", "early")


def count_column(kind: str, window: int) -> str:
    return f"cnt_{kind}_last_{window}d"


def feature_names(horizon: Horizon = HORIZON, vocabulary: Vocabulary = VOCABULARY) -> list[str]:
    """The feature columns in their fixed order."""
    first, second, third = horizon.windows
    names = ["recency_days"]
    for w in horizon.windows:
        names += [f"n_events_last_{w}d", f"active_days_last_{w}d"]
        names += [count_column(kind, w) for kind in vocabulary.listed]
    names += [f"freq_trend_{first}_{second}", f"freq_trend_{second}_{third}", f"active_ratio_{first}d"]
    names += [f"inactive_{d}d" for d in horizon.inactive_flags]
    names += [
        "has_any_activity_hist",
        f"n_session_events_last_{first}d",
        f"n_email_engagement_last_{first}d",
        f"n_orders_last_{first}d",
        f"session_share_{first}d",
        f"email_share_{first}d",
        f"events_per_active_day_{first}d",
        f"click_to_open_{first}d",
    ]
    return names


def event_tallies(log: DataFrame, anchor: datetime, horizon: Horizon = HORIZON,
                  vocabulary: Vocabulary = VOCABULARY, fold_old: bool = False) -> DataFrame:
    """Rows per customer, calendar date, part of the date and listed kind (null for other kinds).

    The part of a date after the anchor's time of day is one day younger than the part
    before. With ``fold_old`` everything beyond the lookback becomes one row per customer,
    as only its smallest age matters.
    """
    dated = log.select(
        ID,
        F.when(F.col(KIND).isin(*vocabulary.listed), F.col(KIND)).alias(KIND),
        age_days(F.col(TIME), anchor).alias("age"),
        day_offset(F.col(TIME), anchor).alias(OFFSET),
    )
    late = F.col("age") < F.col(OFFSET)
    keys = {ID: F.col(ID), OFFSET: F.col(OFFSET), LATE: late, KIND: F.col(KIND)}
    counted = [F.count("*").alias("n")]
    if fold_old:
        recent = F.col("age") < horizon.lookback
        keys = {k: c if k == ID else F.when(recent, c) for k, c in keys.items()}
        counted.append(F.min("age").alias(OLD_AGE))
    keyed = dated.select(*[c.alias(k) for k, c in keys.items()], "age")
    return keyed.groupBy(*keys).agg(*counted)


def folded_tallies(tallies: DataFrame, horizon: Horizon = HORIZON) -> DataFrame:
    """Tallies with everything beyond the lookback in one row per customer, as ``event_tallies`` gives them with ``fold_old``."""
    age = F.col(OFFSET) - F.col(LATE).cast("int")
    recent = age < horizon.lookback
    keys = {c: F.col(c) if c == ID else F.when(recent, F.col(c)) for c in (ID, OFFSET, LATE, KIND)}
    keyed = tallies.select(*[c.alias(k) for k, c in keys.items()], age.alias("age"), "n")
    return keyed.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("age").alias(OLD_AGE))


def daily_counts(tallies: DataFrame, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """One row per customer and calendar date, with the counts of both parts of the date side by side."""
    sums = []
    for part, chosen in (("late", LATE), ("early", f"NOT {LATE}")):
        sums.append(f"sum(if({chosen}, n, 0)) AS {part}_{EVERYTHING}")
        sums += [
            f"sum(if({chosen} AND {KIND} = '{kind}', n, 0)) AS `{part}_{kind}`" for kind in vocabulary.listed
        ]
    if OLD_AGE in tallies.columns:
        sums.append(f"min(if({OFFSET} IS NULL, {OLD_AGE}, NULL)) AS {OLD_AGE}")
    return tallies.groupBy(ID, OFFSET).agg(*[F.expr(text) for text in sums])


def _by_customer(tallies: DataFrame) -> DataFrame:
    """Bring customers together in as many partitions as the session's shuffles have.

    The number is given, so that the adaptive planner does not merge them: narrow rows
    come in, but each becomes several wide rows later in the same task.
    """
    partitions = int(tallies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tallies.repartition(partitions, ID)


def _steps_reached(horizon: Horizon, first_step: int, last_step: int) -> tuple[Column, Column]:
    """First and last snapshot index for which a daily row lies in the lookback or the outcome window."""
    def floor_div(value: Column, by: int) -> Column:
        return F.floor(value / F.lit(by)).cast("int")

    low = floor_div(F.col(OFFSET) - horizon.lookback - 1, horizon.step) + 1
    high = floor_div(F.col(OFFSET) + horizon.outcome, horizon.step)
    return F.greatest(low, F.lit(first_step)), F.least(high, F.lit(last_step))


def _fan_out(daily: DataFrame, horizon: Horizon, first_step: int, last_step: int) -> DataFrame:
    low, high = _steps_reached(horizon, first_step, last_step)
    # A sequence counts downward when its start is past its end, hence the filter before it.
    return daily.filter(low <= high).withColumn(STEP, F.explode(F.sequence(low, high)))


def _window_sums(horizon: Horizon, vocabulary: Vocabulary) -> list[Column]:
    """Sums over daily rows, which carry the ages ``late_age`` and ``early_age`` of their two parts.

    Many columns of one shape: written as SQL text, which is one call each.
    """
    def inside(part: str, low: int, high: int) -> str:
        return f"({part}_age >= {low} AND {part}_age < {high})"

    def seen(part: str, low: int, high: int) -> str:
        return f"({inside(part, low, high)} AND {part}_{EVERYTHING} > 0)"

    def total(kind: str, low: int, high: int) -> str:
        return "sum(" + " + ".join(f"if({inside(p, low, high)}, `{p}_{kind}`, 0)" for p in PARTS) + ")"

    sums = []
    for w in horizon.windows:
        sums.append(f"{total(EVERYTHING, 0, w)} AS n_events_last_{w}d")
        sums.append(f"count(if({seen('late', 0, w)} OR {seen('early', 0, w)}, 1, NULL)) AS active_days_last_{w}d")
        sums += [f"{total(kind, 0, w)} AS `{count_column(kind, w)}`" for kind in vocabulary.listed]
    sums.append(f"{total(EVERYTHING, -horizon.outcome, 0)} AS {horizon.future_count}")
    nearest = " ".join(f"WHEN {seen(p, 0, horizon.lookback)} THEN {p}_age" for p in PARTS)
    sums.append(f"min(CASE {nearest} END) AS {RECENT_AGE}")
    return [F.expr(text) for text in sums]


def with_derived(counted: DataFrame, horizon: Horizon = HORIZON, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Add trends, ratios and flags. All counts are present, and no divisor can be zero."""
    first, second, third = horizon.windows
    n = {w: f"n_events_last_{w}d" for w in horizon.windows}
    active = f"active_days_last_{first}d"

    def cnt(*kinds: str) -> str:
        return "(" + " + ".join(f"`{count_column(kind, first)}`" for kind in kinds) + ")"

    sessions = cnt(*vocabulary.sessions) if vocabulary.sessions else "0L"
    email = cnt(vocabulary.opened, vocabulary.clicked)
    derived = {
        f"freq_trend_{first}_{second}": f"{n[first]} / ({n[second]} + 1)",
        f"freq_trend_{second}_{third}": f"{n[second]} / ({n[third]} + 1)",
        f"active_ratio_{first}d": f"{active} / {first}",
        "has_any_activity_hist": "int(has_history)",
        f"n_session_events_last_{first}d": sessions,
        f"n_email_engagement_last_{first}d": email,
        f"n_orders_last_{first}d": cnt(vocabulary.ordered),
        f"session_share_{first}d": f"{sessions} / ({n[first]} + 1)",
        f"email_share_{first}d": f"{email} / ({n[first]} + 1)",
        f"events_per_active_day_{first}d": f"{n[first]} / ({active} + 1)",
        f"click_to_open_{first}d": f"{cnt(vocabulary.clicked)} / ({cnt(vocabulary.opened)} + 1)",
        **{f"inactive_{limit}d": f"int(recency_days > {limit})" for limit in horizon.inactive_flags},
    }
    return counted.withColumns({name: F.expr(text) for name, text in derived.items()})


def snapshot_features(
    log: DataFrame,
    anchor: datetime,
    horizon: Horizon = HORIZON,
    vocabulary: Vocabulary = VOCABULARY,
    first_step: int = 0,
    last_step: int = 0,
    history: str = "lookback",
    together: bool = False,
) -> DataFrame:
    """Features and outcome of every customer at the snapshots ``anchor - k * step``.

    ``history`` says who is a customer of a snapshot: anyone seen within the lookback
    (``"lookback"``), or anyone seen at all up to it (``"full"``, one snapshot only).
    Columns: id, ``snapshot_index``, ``snapshot_time``, the features, the number of
    events in the outcome window, and the label. ``together`` says that the rows of a customer
    already lie in one partition, as in a table bucketed by customer; nothing is shuffled then.
    """
    if history not in ("lookback", "full"):
        raise ValueError("history is 'lookback' or 'full'")
    if first_step > last_step or first_step < 0:
        raise ValueError("snapshot steps must be a non-empty range from zero up")
    full = history == "full"
    if full and (first_step, last_step) != (0, 0):
        raise ValueError("full history is for a single snapshot")

    time = F.col(TIME)
    newest = instant(anchor) - days(first_step * horizon.step) + days(horizon.outcome)
    oldest = instant(anchor) - days(last_step * horizon.step + horizon.lookback)
    relevant = log.filter(time <= newest) if full else log.filter((time > oldest) & (time <= newest))

    tallies = event_tallies(relevant, anchor, horizon, vocabulary, fold_old=full)
    placed = tallies if together else _by_customer(tallies)
    return features_of_tallies(placed, anchor, horizon, vocabulary, first_step, last_step, full)


def features_of_tallies(tallies: DataFrame, anchor: datetime, horizon: Horizon, vocabulary: Vocabulary,
                        first_step: int, last_step: int, full: bool) -> DataFrame:
    """The columns of ``snapshot_features`` from ``event_tallies``, which lie together by customer."""
    daily = daily_counts(tallies, vocabulary)
    if full:
        spread = daily.withColumn(STEP, F.lit(0))
    else:
        spread = _fan_out(daily, horizon, first_step, last_step)

    early_age = F.col(OFFSET) - F.col(STEP) * horizon.step
    aged = spread.withColumns({"late_age": early_age - 1, "early_age": early_age})
    sums = _window_sums(horizon, vocabulary)
    if full:
        sums.append(F.min(OLD_AGE).alias(OLD_AGE))
    counted = aged.groupBy(STEP, ID).agg(*sums)
    age = F.coalesce(F.col(RECENT_AGE), F.col(OLD_AGE)) if full else F.col(RECENT_AGE)
    counted = counted.withColumns({
        "recency_days": F.coalesce(age, F.lit(RECENCY_UNKNOWN)).cast("int"),
        "has_history": age.isNotNull(),
    }).filter("has_history")

    return with_derived(counted, horizon, vocabulary).select(
        ID,
        STEP,
        (instant(anchor) - days(F.col(STEP) * horizon.step)).alias(SNAPSHOT),
        *feature_names(horizon, vocabulary),
        horizon.future_count,
        (F.col(horizon.future_count) == 0).cast("int").alias(horizon.target),
    )


def customer_features(log: DataFrame, snapshot: datetime, horizon: Horizon = HORIZON,
                      vocabulary: Vocabulary = VOCABULARY, history: str = "full", together: bool = False) -> DataFrame:
    """One row per customer: the id and the features at ``snapshot``."""
    known = log.filter(F.col(TIME) <= instant(snapshot))
    features = snapshot_features(known, snapshot, horizon, vocabulary, history=history, together=together)
    return features.select(ID, *feature_names(horizon, vocabulary))


def customer_recency(log: DataFrame, snapshot: datetime) -> DataFrame:
    """Last event of every customer up to ``snapshot``, and whole days since."""
    return (
        log.filter(F.col(TIME) <= instant(snapshot))
        .groupBy(ID)
        .agg(F.max(TIME).alias("last_event_time"))
        .withColumn("recency_days", age_days(F.col("last_event_time"), snapshot))
    )
