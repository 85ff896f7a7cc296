"""The registered queries of this package: each applies an operator to its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    chat, decontamination, exact_dedup, hyperminhash, jaccard_join, lexical_search, line_dedup, mixing, periodic_runs,
    personal_data, token_counts, toxicity, url_filter,
)
from ebbtide.llm.common import stored, table, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}
HARD_CHAT = "</s>[INST] ok [/INST]"


def registered(query: Query) -> Query:
    _REGISTRY[query.__name__] = query
    return query


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


@registered
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path(token_counts.VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@registered
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.benchmark_leaks(docs, table(spark, folder, "benchmark"))


@registered
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = {k: k for k in personal_data.KINDS}
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(personal_data.span_text(kinds), 256).alias("base_sha256"),
        personal_data.span_text({**kinds, "term": "term"}).alias("spans"), F.size("term").cast("long").alias("n_term"),
        F.sha2(F.col("sanitised"), 256).alias("sanitised_sha256"), F.length("sanitised").cast("long").alias("sanitised_chars"),
    )


@registered
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """The table has the layout of turns; conversation -7 comes as a prompt and its completion."""
    rows = chat.turns_by_conversation(table(spark, folder, "conversations"))
    # What ``formatted_chats`` sees are records of two layouts in one table.
    hard = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(HARD_CHAT).alias("prompt"), F.lit(HARD_CHAT).alias("completion")
    )
    done = chat.formatted_chats(rows.unionByName(hard, allowMissingColumns=True))
    turns = done.withColumn("_turns", chat.read_back(F.col("formatted"))).withColumn("_loss", chat.loss_text(F.col("pieces")))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@registered
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    held_out = toxicity.fold_of(F.col("doc_id")) == 0
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("toxic_spans").alias("n_spans"))


@registered
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@registered
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = exact_dedup.exact_dedup(docs)
    return found.select("doc_id", "keep_id", "group_size", "kept", _hex(F.col("digest")).alias("text_sha256"))


@registered
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: its class, the rows with an equal set, and its links."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard_join.with_classes(*jaccard_join.similarity_classes(docs)).select("doc_id", "class_id", "copies", "n_links")


@registered
def op9_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of pages are the labels with the same id: bad is of low quality or toxic."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_filter.judged_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


@registered
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = stored(docs.select("doc_id", "source", mixing.word_count(text_or_empty()).alias("size")))
    mixed = mixing.mix(sized, size="size")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@registered
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lexical_search.lexical_search(docs, table(spark, folder, "benchmark").select("item_id", "text"))


def _part_repeated(text: Column, doc_id: Column) -> Column:
    """The contract's input: of a tenth of the documents, chosen by a hash of the id, the words from one place on repeat a stretch."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, h = F.size(words), F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    copies = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(text)


@registered
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(docs, _part_repeated(text_or_empty(), F.col("doc_id")))
    best = periodic_runs.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.run_text(F.col("runs")), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@registered
def op13_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = hyperminhash.with_components(*hyperminhash.near_classes(docs))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
