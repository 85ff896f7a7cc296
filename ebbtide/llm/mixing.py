"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every document of a source expects the same number of copies, target over size. The prefix sum of these numbers over
the source, plus one random offset of the source, is cut at the integers: a document is taken once per integer that its stretch holds.
Documents are put in order by size, so the sample has small and large ones in proportion. Within a source the
prefix sum is made in two steps, over blocks of some ten thousand rows and within each of them, so a source with a third of
all rows is not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import REST, join_hot, packed, stored, text_or_empty, unpacked

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"
BLOCK_ROWS = 1 << 14


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Adds ``target``. sizes: one row per source (source, source_size, n), so a window over all of them is small.

    Targets share the sum of all sizes by weight. A source that would get more than ``most`` times its size gets that, and what
    is over goes to the others by weight: sources are filled in the order of most * size / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    listed = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place + 1).cast("int"))
    ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = (
        sizes.withColumn("_w", listed).withColumn("_cap", F.lit(most) * F.col("source_size"))
        .withColumn("_all", F.sum("source_size").over(everything)).withColumn("_weights", F.sum("_w").over(everything))
        .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_w_before", F.coalesce(F.sum("_w").over(before), F.lit(0)))
        .withColumn("_level", (F.col("_all") - F.col("_cap_before")) / (F.col("_weights") - F.col("_w_before")))
        # The level of the first source that isn't filled up holds for all that follow.
        .withColumn("_free", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")))
        .withColumn("_final", F.first("_free", ignorenulls=True).over(ratio.rowsBetween(Window.unboundedPreceding, 0)))
    )
    target = F.when(F.col("_final").isNull(), F.col("_cap").cast("double")).otherwise(F.col("_final") * F.col("_w"))
    return filled.withColumn("target", target).select(*sizes.columns, "target")


def offset_of(source: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the seed and the source only."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def id_hash(doc_id: Column) -> Column:
    """A number below 2^32 that depends on the id only."""
    return F.conv(F.substring(F.md5(doc_id.cast("long").cast("string")), 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED, size: str | None = None
) -> DataFrame:
    """The columns of ``docs`` and size, source_size, target, copies.

    Size is the number of words between ASCII white space (null text: 0), or the column that ``size`` names. Null is a source of its own, the last one. Rows that
    repeat an id are documents of their own. Documents of size 0 take part and weigh nothing. The same rows give the same
    copies again, however they are partitioned. Columns of ``docs`` with the four names are replaced.
    """
    added = ("size", "source_size", "target", "copies")
    counted = word_count(text_or_empty()) if size is None else F.col(size).cast("long")
    needed = ["doc_id", "source"]
    base = packed(docs, needed, size=counted)
    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = stored(source_targets(sources, weights, most))
    # A null source joins through a name that no other source has.
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("_name")
    facts = targets.select(name, "source_size", F.col("n").alias("_n"), "target")
    spread = F.concat(F.lit("#"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    known = join_hot(base.select("*", name), facts, "_name", "_n", spread)
    # Blocks: the binary length of the size, then a hash of the id, whatever steps ids come in. Rows without one go by what they hold.
    blocks = (F.floor((F.col("_n") - 1) / F.lit(BLOCK_ROWS)) + 1).cast("long")
    placed = known.withColumn("_band", F.length(F.bin("size"))).withColumn(
        "_block", F.pmod(F.coalesce(id_hash(F.col("doc_id")), F.xxhash64(REST)), blocks)
    )
    block = ["_name", "_band", "_block"]
    counts = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows"))
    order = Window.partitionBy("_name").orderBy("_band", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_rows").over(order), F.lit(0))).drop("_rows")
    # The rest of the row decides between rows that repeat an id.
    inside = Window.partitionBy(*block).orderBy("size", F.col("doc_id").asc_nulls_first(), F.xxhash64(REST))
    ranked = placed.withColumn("_rank", F.row_number().over(inside)).join(starts, block)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = (F.col("_start") + F.col("_rank")).cast("double")
    upto = lambda k: F.floor(k * F.col("_rate") + F.col("_offset"))
    copies = (upto(F.col("_place")) - upto(F.col("_place") - 1)).cast("long")
    drawn = ranked.withColumn("_rate", rate).withColumn("_place", place).withColumn("_offset", offset_of(F.col("source"), seed))
    return unpacked(drawn.withColumn("copies", copies), docs, needed, {c: F.col(c) for c in added})


def emitted(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each taken document as often as it was taken, with a copy number from 1 in ``copy``, which replaces a column of that name."""
    kept = [F.col(f"`{c}`") for c in columns if c.lower() != "copy"]
    return mixed.where("copies > 0").select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
