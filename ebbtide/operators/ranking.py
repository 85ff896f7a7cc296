"""Running totals and exact quantiles over a score, without sorting a table in one task.

Rows are first summed per distinct score. Where the number of distinct scores has a
known small bound, one window per group does the rest. Otherwise the score axis is cut
into ranges that hold about equally many distinct scores; totals of the ranges are
added up (there are only as many rows as ranges), and each range is sorted in a task
of its own. Ties are one row, so no number of equal scores can overload a range.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import ensure_checkpoint_folder

RANGE = "score_range"
ROWS_PER_RANGE = 1_000_000


def per_score(df: DataFrame, group: list[str], score: str, sums: dict[str, Column]) -> DataFrame:
    """One row per group and distinct score; combines before the shuffle."""
    return df.groupBy(*group, score).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def _add_ranges(scores: DataFrame, score: str, ranges: int, group: list[str]) -> DataFrame:
    if ranges < 2:
        return scores.withColumn(RANGE, F.lit(0.0))
    cutter = QuantileDiscretizer(
        numBuckets=ranges, inputCol=score, outputCol=RANGE, relativeError=0.1 / ranges, handleInvalid="keep"
    )
    return cutter.fit(scores).transform(scores)


def running_totals(
    scores: DataFrame,
    group: list[str],
    score: str,
    values: list[str],
    descending: bool = True,
    bounded: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``run_<value>``: the value summed from the first score to this one, inclusive.

    ``scores`` holds one row per group and distinct score. ``bounded`` states that their
    number per group is small by construction (rounded scores). Otherwise the rows are
    checkpointed, so that range limits, range totals and rows see the same data.
    """
    direction = F.col(score).desc() if descending else F.col(score).asc()
    anchor = group or [F.lit(0)]
    if bounded:
        whole = Window.partitionBy(*anchor).orderBy(direction)
        return scores.withColumns({f"run_{v}": F.sum(v).over(whole) for v in values})

    ensure_checkpoint_folder(scores.sparkSession)
    fixed = scores.checkpoint()
    ranges = math.ceil(fixed.count() / rows_per_range)
    if ranges < 2:
        return running_totals(fixed, group, score, values, descending, bounded=True)

    ranged = _add_ranges(fixed, score, ranges, group)
    totals = ranged.groupBy(*group, RANGE).agg(*[F.sum(v).alias(f"in_{v}") for v in values])
    # Ranges rise with the score. At most one row per group and range is sorted here.
    order = F.col(RANGE).desc() if descending else F.col(RANGE).asc()
    before = Window.partitionBy(*anchor).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, RANGE, *[F.coalesce(F.sum(f"in_{v}").over(before), F.lit(0)).alias(f"before_{v}") for v in values]
    )
    inside = Window.partitionBy(*group, RANGE).orderBy(direction)
    summed = ranged.withColumns({f"run_{v}": F.sum(v).over(inside) for v in values})
    # Null groups are groups too, so the keys are compared null-safely.
    left, right = summed.alias("l"), offsets.alias("r")
    same = reduce(
        lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*group, RANGE)]
    )
    return left.join(right, same).select(
        *[F.col(f"l.{c}") for c in scores.columns],
        *[(F.col(f"l.run_{v}") + F.col(f"r.before_{v}")).alias(f"run_{v}") for v in values],
    )


#: Size of a quantile sketch: the rank of an estimate is off by at most ``sketch_error`` of the rows, with 99 % confidence.
SKETCH_K = 400


def sketch_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a sketch of size ``k`` (fixed values of the method's published error curve)."""
    return 2.296 / k**0.9021


def quantile_sketches(df: DataFrame, column: str, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """One mergeable sketch of a column per group, for example per month: a few kilobytes each, kept beside the data."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"), F.count(column).alias("n_rows"))


def sketched_quantiles(sketches: DataFrame, shares: tuple[float, ...], names: tuple[str, ...], by: list[str] | None = None) -> DataFrame:
    """Estimated quantiles over all given sketches, or per group of them; the data are not read again.

    ``exact_quantiles`` is the exact way. Sketches are merged before the shuffle, so no task gets more than a group's sketches.
    """
    merged = sketches.groupBy(*(by or [])).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"))
    picks = [F.kll_sketch_get_quantile_double("sketch", F.lit(s)).alias(n) for s, n in zip(shares, names)]
    return merged.select(*(by or []), "n_rows", *picks)


def exact_quantiles(df: DataFrame, column: str, shares: tuple[float, ...], names: tuple[str, ...],
                    bounded: bool = False, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Linearly interpolated quantiles of a column: one row, one column per share."""
    counted = per_score(df.filter(F.col(column).isNotNull()), [], column, {"n": F.lit(1)})
    ranked = running_totals(counted, [], column, ["n"], descending=False, bounded=bounded, rows_per_range=rows_per_range)
    if bounded:
        total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    else:
        total = ranked.agg(F.max("run_n").alias("total")).scalar()
    ranked = ranked.withColumn("last", total - 1)

    def value_at(position: Column) -> Column:
        first = F.col("run_n") - F.col("n")
        return F.max(F.when((first <= position) & (position < F.col("run_n")), F.col(column)))

    picks = []
    for share, name in zip(shares, names):
        place = F.col("last") * F.lit(share)
        picks += [
            value_at(F.floor(place)).alias(f"{name}_low"),
            value_at(F.ceil(place)).alias(f"{name}_high"),
            F.max(place - F.floor(place)).alias(f"{name}_part"),
        ]
    found = ranked.agg(*picks)

    def between(name: str) -> Column:
        low, high, part = F.col(f"{name}_low"), F.col(f"{name}_high"), F.col(f"{name}_part")
        gap = high - low
        return F.when(part < 0.5, low + gap * part).otherwise(high - gap * (1 - part))

    return found.select(*[between(n).alias(n) for n in names])
