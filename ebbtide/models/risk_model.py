"""A fitted model together with everything needed to apply it the same way later."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import PROBABILITY
from ebbtide.operators.matrix import feature_matrix
from ebbtide.sources.readers import read_feature_list
from ebbtide.sources.sinks import write_feature_list, write_json

VECTOR = "features"
LABEL = "label"
WEIGHT = "weight"
#: Rows of a batch of stored vectors.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.inMemoryColumnarStorage.batchSize"


def vectors(rows: DataFrame, features: list[str], keep: Iterable[str], transform: str) -> DataFrame:
    """``keep`` columns and one feature vector."""
    kept = list(keep)
    matrix = feature_matrix(rows, features, kept, transform)
    return VectorAssembler(inputCols=features, outputCol=VECTOR).transform(matrix).select(*kept, VECTOR)


def stored_vectors(data: DataFrame) -> DataFrame:
    """The rows persisted on the disks of the executors; their memory is left to what a fit reads in each iteration.

    Java's serializer holds on to the last hundred batches that a task has written or read: at the usual 10,000 rows some 300 MB a task.
    """
    settings = data.sparkSession.conf
    before = settings.get(_BATCH_SETTING)
    settings.set(_BATCH_SETTING, str(BATCH_ROWS))
    try:
        stored = data.persist(StorageLevel.DISK_ONLY)
        stored.count()
    finally:
        settings.set(_BATCH_SETTING, before)
    return stored


def class_shares(counts: dict) -> dict:
    """Weight of a row of each class so that all classes weigh the same."""
    return {label: sum(counts.values()) / (len(counts) * n) for label, n in counts.items()}


def balanced_weight(rows: DataFrame, target: str, counts: dict | None = None) -> Column:
    """Weight of a row so that both classes weigh the same. Two counts come to the driver, unless they are there already."""
    if counts is None:
        counts = {r[target]: r["count"] for r in rows.groupBy(target).count().collect()}
    weight = F.lit(None).cast("double")
    for label, share in sorted(class_shares(counts).items()):
        weight = F.when(F.col(target) == label, F.lit(share)).otherwise(weight)
    return weight


@dataclass
class RiskModel:
    """Stages, the ordered features, the transform of the counts, and the columns to average."""

    stages: PipelineModel
    features: list[str]
    transform: str
    outputs: list[str]

    def predict(self, rows: DataFrame, keep: Iterable[str]) -> DataFrame:
        """``keep`` columns and the probability of inactivity."""
        kept = list(keep)
        scored = self.stages.transform(vectors(rows, self.features, kept, self.transform))
        chances = [vector_to_array(F.col(c))[1] for c in self.outputs]
        return scored.select(*kept, (reduce(lambda a, b: a + b, chances) / len(chances)).alias(PROBABILITY))

    def save(self, spark: SparkSession, folder: str) -> None:
        self.stages.write().overwrite().save(f"{folder}/stages")
        write_feature_list(spark, self.features, f"{folder}/features")
        settings = [(self.transform, ",".join(self.outputs))]
        write_json(spark.createDataFrame(settings, "transform string, outputs string"), f"{folder}/settings")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> RiskModel:
        settings = spark.read.schema("transform string, outputs string").json(f"{folder}/settings").first()
        return RiskModel(
            PipelineModel.load(f"{folder}/stages"),
            read_feature_list(spark, f"{folder}/features"),
            settings["transform"],
            settings["outputs"].split(","),
        )
