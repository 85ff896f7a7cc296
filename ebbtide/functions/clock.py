"""Time columns.

Inside the library an instant is a zone-free timestamp holding UTC clock time,
so that no result depends on the zone of the session.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ONE_MICRO = timedelta(microseconds=1)


def utc_naive(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def instant(moment: datetime) -> Column:
    """A literal instant."""
    return F.lit(utc_naive(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def days(n: Column | int) -> Column:
    """A span of whole 24-hour days."""
    return F.make_dt_interval(n if isinstance(n, Column) else F.lit(n))


def _utc_clock(moment: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), epoch)


#: Dates of a fixed shape beside ISO, by the place and sign that tells them; a clock may follow, with or without AM or PM.
_CLOCK = r"^( [0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?( [AP]M)?)?$"
_SLASHED, _DOTTED, _YEAR_SLASHED = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}", r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}", r"^[0-9]{4}/[0-9]{2}/[0-9]{2}"
_COMPACT = r"^[0-9]{8}(\s|$)"


def _whole_day(clock: Column) -> Column:
    """A clock with AM or PM as one of 24 hours; others as they are, null where it is none."""
    hour = F.substring(clock, 2, 2).cast("int")
    afternoon = F.substring(clock, -2, 2) == "PM"
    full = F.concat(F.lit(" "), F.lpad((hour % 12 + F.when(afternoon, 12).otherwise(0)).cast("string"), 2, "0"),
                    F.substr(clock, F.lit(4), F.length(clock) - 6))
    return (
        F.when(~clock.rlike(_CLOCK), F.lit(None).cast("string"))
        .when(~clock.endswith("M"), clock)
        .when(hour.between(1, 12), full)
    )


def _iso_text(text: Column, day_first: bool) -> Column:
    """The text in ISO form, by its shape alone: nothing is tried out, so a bad text costs no more than a good one."""
    piece = lambda start, length: F.substring(text, start, length)
    rest = lambda start: F.upper(F.substr(text, F.lit(start), F.length(text)))
    dash = F.lit("-")
    one, two = piece(1, 2).cast("int"), piece(4, 2).cast("int")
    by_month = F.concat(piece(7, 4), dash, piece(1, 2), dash, piece(4, 2))
    by_day = F.concat(piece(7, 4), dash, piece(4, 2), dash, piece(1, 2))
    # The other order where the first can't be: only days after the 12th show it.
    slashed = F.when(two <= 12, by_day).when(one <= 12, by_month) if day_first else F.when(one <= 12, by_month).when(two <= 12, by_day)
    sign, fifth = piece(3, 1), piece(5, 1)
    # A zone needs seconds before it, and a colon.
    whole = F.regexp_replace(text, r"^(.{10} [0-9]{2}:[0-9]{2}) ([+-][0-9]{4})$", "$1:00 $2")
    zoned = F.regexp_replace(whole, r" ([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    return (
        F.when((fifth == "-") & ~F.upper(piece(-2, 2)).isin("AM", "PM"), zoned)
        .when(fifth == "-", F.concat(piece(1, 10), _whole_day(rest(11))))
        .when((fifth == "/") & text.rlike(_YEAR_SLASHED), F.concat(F.translate(piece(1, 10), "/", "-"), _whole_day(rest(11))))
        .when((sign == "/") & text.rlike(_SLASHED), F.concat(slashed, _whole_day(rest(11))))
        .when((sign == ".") & text.rlike(_DOTTED), F.concat(by_day, _whole_day(rest(11))))
        # Texts of eight digits are dates, not years.
        .when(text.rlike(_COMPACT), F.concat(piece(1, 4), dash, piece(5, 2), dash, piece(7, 2), _whole_day(rest(9))))
        .otherwise(text)
    )


def parse_utc(text: Column, day_first: bool = False) -> Column:
    """Text to an instant; null where it is no time. A zone in the text is honoured.

    ISO is read in all its forms, and dates as 2024/01/31, 20240131, 31.01.2024, 01/31/2024, each with a clock behind it. Where day
    and month could be exchanged, the month comes first; ``day_first`` is for logs in which 02/01/2024 is in January. A day after the
    12th shows by itself which number it is. ``day_order`` decides for a whole log.
    """
    plain = F.trim(text)
    # ISO is read as it is; only other texts are rewritten, and once for all the places where the rewritten text is needed.
    usual = (F.substring(plain, 5, 1) == "-") & ~plain.rlike(r" ([AaPp][Mm]|[+-][0-9]{4})$")
    rewritten = F.transform(F.array(plain), lambda t: _iso_text(t, day_first))
    return F.when(usual, _iso_instant(plain)).otherwise(F.element_at(F.transform(rewritten, _iso_instant), 1))


def _iso_instant(iso: Column) -> Column:
    has_zone = iso.rlike(r":\d{2}(\.\d+)?\s*[A-Za-z+\-]")
    return F.when(has_zone, _utc_clock(iso.try_cast("timestamp"))).otherwise(iso.try_cast("timestamp_ntz"))


def order_marks(text: Column) -> dict[str, Column]:
    """Tests on texts such as 02/01/2024: the day must come first, the month must come first, or both could and differ."""
    plain = F.trim(text)
    one, two = F.substring(plain, 1, 2).cast("int"), F.substring(plain, 4, 2).cast("int")
    shaped = (F.substring(plain, 3, 1) == "/") & plain.rlike(_SLASHED)
    test = {"day_first": (one > 12) & (two <= 12), "month_first": (one <= 12) & (two > 12), "either": (one <= 12) & (two <= 12) & (one != two)}
    return {name: F.coalesce(F.when(shaped, t), F.lit(False)) for name, t in test.items()}


def day_order(log: DataFrame, column: str) -> DataFrame:
    """One row about a column of text: how many times must be read with the day or the month first, how many with either, and day_first.

    The day comes first if some times say so and none says the opposite: a log is taken to write all its times in one way.
    """
    if not isinstance(log.schema[column].dataType, T.StringType):
        return log.sparkSession.range(1).select(
            *[F.lit(0).cast("long").alias(n) for n in ("day_first_times", "month_first_times", "ambiguous_times")], F.lit(False).alias("day_first")
        )
    marks = order_marks(F.col(f"`{column}`"))
    counted = log.agg(
        F.count_if(marks["day_first"]).alias("day_first_times"), F.count_if(marks["month_first"]).alias("month_first_times"),
        F.count_if(marks["either"]).alias("ambiguous_times"),
    )
    return counted.withColumn("day_first", (F.col("day_first_times") > 0) & (F.col("month_first_times") == 0))


def as_instant(column: Column, kind: T.DataType, day_first: bool = False) -> Column:
    """Bring any column that means a time to a UTC instant."""
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.TimestampType):
        return _utc_clock(column)
    if isinstance(kind, T.DateType):
        return column.cast("timestamp_ntz")
    return parse_utc(column.cast("string"), day_first)


def moment_like(kind: T.DataType, moment: datetime) -> Column:
    """A literal of the same type as a stored time column, so that a filter reaches the scan."""
    if isinstance(kind, T.TimestampType):
        return F.lit(utc_naive(moment).isoformat(sep=" ") + "Z").cast("timestamp")
    return instant(moment)


def month_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def day_offset(moment: Column, anchor: datetime) -> Column:
    """Calendar dates between the date of ``moment`` and the date of ``anchor``."""
    return F.datediff(F.lit(utc_naive(anchor).date()), F.to_date(moment))


def age_days(moment: Column, anchor: datetime) -> Column:
    """Whole 24-hour days from ``moment`` to ``anchor``, rounded down (negative after it).

    Days end at the anchor's time of day, so the clock is moved back by that time
    (and one microsecond, as a day includes its end) and calendar dates are compared.
    """
    anchor = utc_naive(anchor)
    midnight = anchor.replace(hour=0, minute=0, second=0, microsecond=0)
    shift = anchor - midnight + _ONE_MICRO
    seconds = F.lit(f"{shift.seconds + shift.days * 86400}.{shift.microseconds:06d}").cast("decimal(18,6)")
    moved = moment - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.datediff(F.lit(anchor.date()), F.to_date(moved)) - 1
