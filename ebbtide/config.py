"""Settings shared by every stage.

The literal values in this file are fixed values: column names, event names,
window lengths, thresholds and model parameters have to agree with the tables
and scores that existing users already hold.
"""

from __future__ import annotations

from dataclasses import dataclass

# Column names of the interaction log and of the score table.
ID = "external_customerkey"
TIME = "event_time"
KIND = "interaction_type"
CHANNEL = "channel"
SHOP = "shop"
MONTH = "event_month"
DAY = "event_date"
SNAPSHOT = "snapshot_time"
PROBABILITY = "churn_probability"
BUCKET = "churn_bucket"
ACTION = "churn_action"

REQUIRED = (ID, TIME, KIND)
OPTIONAL = (CHANNEL, SHOP)
UNUSED = ("amount", "incoming_outgoing")

# Text that stands for "no value".
BLANK_WORDS = ("", "nan", "none", "null")
# What a CSV cell has to say, exactly, to be read as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Vocabulary:
    """Which interactions count as activity, and which get a column of their own."""

    # Activity names, session prefix, and the names with count columns, in column order.
    exact: tuple[str, ...] = ("emarsys_open", "emarsys_click", "order")
    prefix: str = "emarsys_sessions_"
    listed: tuple[str, ...] = (
        "emarsys_open",
        "emarsys_click",
        "order",
        "emarsys_sessions_content_url",
        "emarsys_sessions_content_category",
        "emarsys_sessions_content_tag",
        "emarsys_sessions_content_title",
        "emarsys_sessions_view",
        "emarsys_sessions_category_view",
        "emarsys_sessions_cart_update",
        "emarsys_sessions_purchase",
    )
    opened: str = "emarsys_open"
    clicked: str = "emarsys_click"
    ordered: str = "order"

    @property
    def sessions(self) -> tuple[str, ...]:
        return tuple(name for name in self.listed if name.startswith(self.prefix))


@dataclass(frozen=True)
class Horizon:
    """Window lengths in whole days. Every history window fits in the lookback."""

    # Default lengths in days.
    windows: tuple[int, int, int] = (30, 60, 90)
    lookback: int = 90
    outcome: int = 30
    step: int = 30
    inactive_flags: tuple[int, ...] = (14, 30)

    def __post_init__(self) -> None:
        if len(self.windows) != 3 or list(self.windows) != sorted(set(self.windows)):
            raise ValueError("there are three distinct windows, in ascending order")
        if self.windows[-1] > self.lookback:
            raise ValueError("the longest window must fit in the lookback")
        if min(self.windows[0], self.outcome, self.step) < 1:
            raise ValueError("windows, outcome and step are whole days, at least one")

    @property
    def target(self) -> str:
        return f"churn_{self.outcome}d"

    @property
    def future_count(self) -> str:
        return f"n_activity_events_next_{self.outcome}d"


@dataclass(frozen=True)
class RiskLevels:
    """Lower bounds of the risk buckets; the names are ordered from worst to best."""

    # Bounds and bucket names.
    very_high: float = 0.8
    high: float = 0.6
    medium: float = 0.4
    names: tuple[str, ...] = ("very_high", "high", "medium", "low")
    acted_on: tuple[str, ...] = ("very_high", "high")
    weak_signal: str = "weak_signal"


# Clip and fill for recency, number of evaluated snapshots, percentile bounds.
RECENCY_CAP = 365
RECENCY_UNKNOWN = 999
EVALUATED_SNAPSHOTS = 12
EARLIER_POOL_SIZE = 4
PERCENTILE_BOUNDS = (0.40, 0.70, 0.90)
# Fixed value: size of the customer sample drawn from the warehouse, and its age limit in months.
SAMPLE_SIZE = 200_000
EXTRACT_MONTHS = 36
EXTRACT_DIRECTION = "incoming"

# Columns that hold counts, by prefix, in the order in which they are tested.
COUNT_PREFIXES = (
    "n_events_last_",
    "active_days_last_",
    "cnt_",
    "n_session_events_",
    "n_email_engagement_",
    "n_orders_",
)


@dataclass(frozen=True)
class BoostedSettings:
    """Gradient-boosted trees of MLlib, which grow by level, without leaf penalties."""

    # Training parameters.
    rounds: int = 500
    learning_rate: float = 0.05
    depth: int = 6
    row_fraction: float = 0.8
    column_fraction: float = 0.8
    rows_per_leaf: int = 100
    seed: int = 42
    #: Rounds without a better loss on the rows held back after which fitting stops, and the rounds of the first attempt.
    patience: int = 50
    first_rounds: int = 64


@dataclass(frozen=True)
class LeafwiseSettings:
    """Gradient-boosted trees that grow the best leaf first."""

    # Training parameters.
    rounds: int = 500
    patience: int = 50
    learning_rate: float = 0.05
    leaves: int = 31
    depth: int = 6
    column_fraction: float = 0.8
    row_fraction: float = 0.8
    bag_every: int = 5
    rows_per_leaf: int = 100
    l1: float = 0.1
    l2: float = 0.1
    seed: int = 42
    #: Bins of a feature (at most 255), and the least sum of second derivatives of a leaf.
    bins: int = 255
    least_hessian: float = 1e-3


@dataclass(frozen=True)
class LinearSettings:
    """Logistic model with sigmoid calibration over folds."""

    # Training parameters.
    penalty: float = 1e-4
    max_iterations: int = 100
    tolerance: float = 1e-5
    folds: int = 3


VOCABULARY = Vocabulary()
HORIZON = Horizon()
RISK = RiskLevels()
