"""From the raw interaction log to typed, valid rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ebbtide.config import (
    BLANK_WORDS, CHANNEL, CSV_MISSING, ID, KIND, OPTIONAL, REQUIRED, SHOP, TIME, UNUSED,
)
from ebbtide.functions.clock import as_instant, day_order, instant, order_marks
from ebbtide.functions.text import blank_words_to_null, strip


@dataclass(frozen=True)
class CleaningProfile:
    """How much a cleaner insists on."""

    required: tuple[str, ...]
    lower_case: tuple[str, ...]
    keep_only_known: bool
    blank_words: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    drop_future: bool = False


LENIENT = CleaningProfile(required=REQUIRED, lower_case=(KIND, CHANNEL), keep_only_known=True)
STRICT = CleaningProfile(
    required=REQUIRED + OPTIONAL,
    lower_case=(ID, KIND, CHANNEL, SHOP),
    keep_only_known=False,
    blank_words=BLANK_WORDS,
    dropped=UNUSED,
    drop_future=True,
)

_TEXT = (ID, KIND, CHANNEL, SHOP)
CLEAN, NO_TIME, BAD_TIME, EITHER_ORDER = "is_clean", "has_no_time", "has_bad_time", "has_either_order"


def require_columns(df: DataFrame, names: tuple[str, ...], what: str = "input") -> None:
    """Fail before any job starts when columns are missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")


def csv_missing_to_null(raw: DataFrame) -> DataFrame:
    """Cells that say 'no value' exactly; padded ones are left to the cleaning profile.

    The time column is passed as it is: none of these words is a time.
    """
    return raw.select(*[
        F.col(c) if c.lower() == TIME else blank_words_to_null(F.col(c), CSV_MISSING).alias(c) for c in raw.columns
    ])


def decided_order(raw: DataFrame) -> bool:
    """Whether the day comes first in the log's times: one pass over the time column, one row to the driver."""
    return day_order(raw, next(c for c in raw.columns if c.lower() == TIME)).first()["day_first"]


def _tidied(raw: DataFrame, profile: CleaningProfile, day_first: bool | None) -> tuple[DataFrame, dict[str, Column]]:
    """The log with the names that the profile wants, and the tidy form of each column that stays."""
    if not profile.keep_only_known:
        raw = raw.toDF(*[name.lower() for name in raw.columns])
    require_columns(raw, profile.required, "raw log")
    if day_first is None:
        day_first = decided_order(raw)

    if profile.keep_only_known:
        names = [*REQUIRED, *(c for c in OPTIONAL if c in raw.columns)]
    else:
        names = [c for c in raw.columns if c not in profile.dropped]

    kinds = {field.name: field.dataType for field in raw.schema}

    def tidy(name: str):
        column = F.col(name)
        if name == TIME:
            return as_instant(column, kinds[name], day_first).alias(name)
        if name not in _TEXT:
            return column
        column = strip(column.cast("string"))
        if name in profile.lower_case:
            column = F.lower(column)
        if profile.blank_words:
            column = blank_words_to_null(column, profile.blank_words)
        return column.alias(name)

    return raw, {name: tidy(name) for name in names}


def _not_in_future(as_of: datetime | None) -> Column:
    return F.col(TIME) <= (instant(as_of) if as_of else as_instant(F.current_timestamp(), TimestampType()))


def clean_events(raw: DataFrame, profile: CleaningProfile = LENIENT, as_of: datetime | None = None,
                 day_first: bool | None = False) -> DataFrame:
    """Typed rows with every required column present. One narrow pass, no shuffle.

    ``as_of`` bounds the event time where the profile drops future rows; now, when not given.
    ``day_first`` tells how the log writes times such as 02/01/2024; None looks at the whole log first.
    """
    raw, tidy = _tidied(raw, profile, day_first)
    # Tidying never turns a text into null unless blank words do. Rows without a text go
    # before it, as a test on tidied columns would make the optimiser tidy them twice.
    complete = raw.dropna(subset=[c for c in profile.required if c != TIME])
    late_test = list(profile.required) if profile.blank_words else [TIME]
    cleaned = complete.select(*tidy.values()).dropna(subset=late_test)
    return cleaned.filter(_not_in_future(as_of)) if profile.drop_future else cleaned


def flagged_events(raw: DataFrame, profile: CleaningProfile = LENIENT, as_of: datetime | None = None,
                   day_first: bool | None = False) -> DataFrame:
    """All rows of the raw log in tidy form, with ``CLEAN`` true for those that ``clean_events`` keeps, and three more flags:
    no time at all, a text that is no time, and a time that could be read with the day or the month first."""
    raw, tidy = _tidied(raw, profile, day_first)
    source = {c: F.col(f"`{c}`") for c in raw.columns}
    given = source[TIME].cast("string")
    missing = source[TIME].isNull() | (F.trim(given) == "")
    texts = [source[c].isNotNull() for c in profile.required if c != TIME]
    rows = raw.select(
        *tidy.values(), reduce(and_, texts, F.lit(True)).alias(CLEAN), F.coalesce(missing, F.lit(True)).alias(NO_TIME),
        order_marks(given)["either"].alias(EITHER_ORDER),
    )
    late_test = list(profile.required) if profile.blank_words else [TIME]
    kept = reduce(and_, [F.col(c).isNotNull() for c in late_test], F.col(CLEAN))
    if profile.drop_future:
        kept = kept & _not_in_future(as_of)
    return rows.withColumn(BAD_TIME, ~F.col(NO_TIME) & F.col(TIME).isNull()).withColumn(CLEAN, F.coalesce(kept, F.lit(False)))


def normalise_log(log: DataFrame) -> DataFrame:
    """Bring any log with the three core columns to the types and spelling the operators expect."""
    require_columns(log, REQUIRED, "event log")
    kinds = {field.name: field.dataType for field in log.schema}
    return log.select(
        strip(F.col(ID).cast("string")).alias(ID),
        as_instant(F.col(TIME), kinds[TIME]).alias(TIME),
        F.lower(strip(F.col(KIND).cast("string"))).alias(KIND),
    ).dropna()
