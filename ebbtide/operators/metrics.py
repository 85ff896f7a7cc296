"""Exact ranking and threshold metrics per snapshot."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ranking import per_score, running_totals

# The thresholds tried for the best F1 are i * step + 0.01 for i = 0..98.
_THRESHOLD_START, _THRESHOLD_END, _THRESHOLD_COUNT = 0.01, 0.99, 99


def thresholds() -> list[float]:
    step = (_THRESHOLD_END - _THRESHOLD_START) / (_THRESHOLD_COUNT - 1)
    return [i * step + _THRESHOLD_START for i in range(_THRESHOLD_COUNT - 1)] + [_THRESHOLD_END]


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where it is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _rates(tp: Column, fp: Column, pos: Column, neg: Column, suffix: str = "") -> dict[str, Column]:
    tn = neg - fp
    return {
        f"accuracy{suffix}": _ratio(tp + tn, pos + neg),
        f"precision{suffix}": _ratio(tp, tp + fp),
        f"recall{suffix}": _ratio(tp, pos),
        f"f1{suffix}": _ratio(2 * tp, tp + fp + pos),
    }


def _label_sums(label: str) -> dict[str, Column]:
    flag = F.col(label).cast("bigint")
    return {"pos": flag, "neg": 1 - flag}


def _scored(df: DataFrame, score: str) -> DataFrame:
    """NaN scores pass no threshold, so they rank last."""
    return df.withColumn(score, F.nanvl(F.col(score), F.lit(float("-inf"))))


def classification_metrics(df: DataFrame, group: list[str], score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 at one threshold. One pass, a few sums."""
    hit = F.coalesce((F.col(score) >= threshold) & ~F.isnan(score), F.lit(False))
    positive = F.col(label) == 1
    sums = df.groupBy(*group).agg(
        F.count("*").alias("n_rows"),
        F.count_if(positive).alias("pos"),
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
    )
    pos, tp, fp = F.col("pos"), F.col("tp"), F.col("fp")
    rates = _rates(tp, fp, pos, F.col("n_rows") - pos)
    return sums.select(*group, "n_rows", F.lit(threshold).alias("threshold"), *[c.alias(n) for n, c in rates.items()])


def ranked_scores(df: DataFrame, group: list[str], score: str, label: str, bounded: bool = False, **ranging) -> DataFrame:
    """Per distinct score: positives and negatives, and both counted down from the highest score."""
    counted = per_score(_scored(df, score), group, score, _label_sums(label))
    return running_totals(counted, group, score, ["pos", "neg"], bounded=bounded, **ranging)


def _auc_part() -> Column:
    """Pairs won by the positives against the negatives of one score; a tie is half a win."""
    return (F.col("neg") * (F.col("run_pos") - F.col("pos") / 2)).cast("double")


def _precision_part() -> Column:
    return F.col("pos") * F.col("run_pos") / (F.col("run_pos") + F.col("run_neg"))


def roc_auc(ranked: DataFrame, group: list[str]) -> DataFrame:
    """Area under the ROC curve; null where one class is missing."""
    return ranked.groupBy(*group).agg(
        F.try_divide(F.sum(_auc_part()), (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc")
    )


def average_precision(ranked: DataFrame, group: list[str]) -> DataFrame:
    """Mean of the precision over the positives, by steps (no interpolation)."""
    return ranked.groupBy(*group).agg(
        F.try_divide(F.sum(_precision_part()), F.sum("pos").cast("double")).alias("pr_auc")
    )


def _band(df: DataFrame, score: str) -> DataFrame:
    """Number of thresholds that the score reaches."""
    splits = [float("-inf"), *thresholds(), float("inf")]
    return Bucketizer(splits=splits, inputCol=score, outputCol="band").transform(df)


def threshold_table(df: DataFrame, group: list[str], score: str, label: str) -> DataFrame:
    """Rates at each of the thresholds, from one histogram per group."""
    banded = _band(_scored(df, score), score).withColumn("band", F.col("band").cast("int"))
    counted = banded.groupBy(*group, "band").agg(*[F.sum(c).alias(n) for n, c in _label_sums(label).items()])
    return _expand_thresholds(counted, group, [])


def _expand_thresholds(counted: DataFrame, group: list[str], carried: list[str]) -> DataFrame:
    """From band counts (at most 100 rows per group) to one row per group and threshold."""
    points = F.array(*[F.lit(t) for t in thresholds()])
    # A row counts at every threshold up to its band; bands without rows still have thresholds.
    whole = Window.partitionBy(*group)
    totals = counted.withColumns({
        "all_pos": F.sum("pos").over(whole),
        "all_neg": F.sum("neg").over(whole),
        **{f"all_{c}": F.sum(c).over(whole) for c in carried},
    })
    spread = totals.select("*", F.posexplode(points).alias("place", "threshold"))
    reached = F.col("band") > F.col("place")
    keys = [*group, "threshold", "all_pos", "all_neg", *[f"all_{c}" for c in carried]]
    summed = spread.groupBy(*keys).agg(
        F.sum(F.when(reached, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(reached, F.col("neg")).otherwise(0)).alias("fp"),
    )
    rates = _rates(F.col("tp"), F.col("fp"), F.col("all_pos"), F.col("all_neg"), "_opt")
    return summed.select(*keys, *[c.alias(n) for n, c in rates.items()])


def best_threshold(table: DataFrame, group: list[str], carried: tuple[str, ...] = ()) -> DataFrame:
    """The lowest threshold with the highest F1, and the other rates there."""
    rates = ("f1_opt", "accuracy_opt", "precision_opt", "recall_opt")
    best = F.max_by(F.struct("threshold", *rates), F.struct("f1_opt", (-F.col("threshold")).alias("low"))).alias("best")
    return table.groupBy(*group, *carried).agg(best).select(
        *group, *carried, F.col("best.threshold").alias("threshold_opt"), *[f"best.{r}" for r in rates]
    )


def rolling_evaluation(df: DataFrame, group: list[str], score: str, label: str, threshold: float = 0.5,
                       bounded: bool = False, **ranging) -> DataFrame:
    """All metrics of all snapshots from one chain of aggregations, without a join.

    Distinct scores carry the ranking metrics; they are then folded into threshold bands,
    which carry everything else.
    """
    ranked = _band(ranked_scores(df, group, score, label, bounded, **ranging), score)
    hit = F.col(score) >= threshold
    banded = ranked.groupBy(*group, F.col("band").cast("int").alias("band")).agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("hit_pos"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("hit_neg"),
        F.sum(_auc_part()).alias("auc_part"),
        F.sum(_precision_part()).alias("precision_part"),
    )
    carried = ["hit_pos", "hit_neg", "auc_part", "precision_part"]
    whole = ["all_pos", "all_neg", *[f"all_{c}" for c in carried]]
    best = best_threshold(_expand_thresholds(banded, group, carried), group, tuple(whole))
    pos, neg = F.col("all_pos"), F.col("all_neg")
    rates = _rates(F.col("all_hit_pos"), F.col("all_hit_neg"), pos, neg)
    return best.select(
        *group,
        (pos + neg).alias("n_rows"),
        (pos / (pos + neg)).alias("churn_rate"),
        F.lit(threshold).alias("threshold"),
        *[c.alias(n) for n, c in rates.items()],
        "threshold_opt", "accuracy_opt", "precision_opt", "recall_opt", "f1_opt",
        F.try_divide(F.col("all_auc_part"), (pos * neg).cast("double")).alias("roc_auc"),
        F.try_divide(F.col("all_precision_part"), pos.cast("double")).alias("pr_auc"),
    )
