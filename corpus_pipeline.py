"""From raw documents to a training mix, in five stages.

Each stage gets all rows that the one before kept, with the columns of ``documents``; ``run`` stores them in between, so a lost
executor costs one stage at most. The last stage repeats documents as often as the mix takes them, with a column ``copy`` from 1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontamination, jaccard_join, line_dedup, mixing, toxicity
from ebbtide.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the model, fitted on the labelled ones among them, does not find toxic."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that many documents share out of all but one of them; documents stay, n_chars follows the text."""
    done = line_dedup.line_dedup(docs)
    length = F.length("text").cast("long")
    return done.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of similar documents, of the smallest doc_id; texts without words stay."""
    return jaccard_join.one_of_each_class(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(mixing.mix(docs), docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
]
#: A fitted model and similarity classes have no SQL form; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
