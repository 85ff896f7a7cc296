"""Ranked lexical search of many items over all documents, by dense blocked matrix products.

The items' own terms are a compact vocabulary; other terms of the corpus only count towards lengths. One pass over the texts leaves,
for each document, its length and the places and frequencies of the vocabulary's terms (stored, a few bytes a term). Sums over that table
give the corpus statistics. A second pass multiplies tiles: documents by terms with impacts, terms by items with weights. A tile
holds only terms that both its items and its documents have. All factors are whole numbers, and a tile has so few terms that no partial sum
can reach 2^53; so the float64 products are exact, and tiles are added up in 64-bit integers.

Each tile keeps what is not below the tile's and the task's k-th score, ties included, and each task sends its best k of each item.
Sets of items whose terms pass ``BLOCK_BYTES`` are dealt into blocks, one pass each, so what is broadcast has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ebbtide.llm.common import arrow_limits, stored, text_or_empty

TOP = 10
#: Bytes of the terms of a block of items, each counted with ``TERM_BYTES`` more for its places in tables. An item is never split.
BLOCK_BYTES = 16 << 20
TERM_BYTES = 64
ITEM_TILE, DOC_TILE, TERM_TILE = 256, 512, 1024
SALTS = 32
#: Fixed values of the score: the impact's scale, and the shares of a document's length in thousandths of its weight.
SCALE, LENGTH_SHARE = 10**9, 90
EXACT = 2**53

_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or bytes((b,)).isalnum() else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and anything beyond ASCII, with A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
        rows = pa.array(np.repeat(np.arange(len(own)), [len(o) for o in own]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), pa.array([t for o in own for t in o], pa.binary())], ["item_id", "term"]
        )


@dataclass
class Block:
    """Items with their terms: ``ids`` by place, ``vocabulary`` term to place, and the places' pairs (item, term) in the order of items."""

    ids: list
    vocabulary: dict[bytes, int]
    item: np.ndarray
    term: np.ndarray


def _block(rows: list) -> Block:
    ids, vocabulary, item, term = [], {}, [], []
    for name, own in groupby(rows, itemgetter(0)):
        for _, t in own:
            item.append(len(ids))
            term.append(vocabulary.setdefault(bytes(t), len(vocabulary)))
        ids.append(name)
    return Block(ids, vocabulary, np.array(item, np.int64), np.array(term, np.int64))


def item_blocks(items: DataFrame) -> Iterator[Block]:
    """Blocks of whole items; only one is on the driver at a time."""
    kind = items.schema["item_id"].dataType
    texts = items.select("item_id", text_or_empty().cast("binary").alias("t"))
    schema = StructType([StructField("item_id", kind), *StructType.fromDDL("term binary").fields])
    found = stored(texts.mapInArrow(_item_terms, schema).distinct())
    weight = found.agg(F.coalesce(F.sum(F.length("term") + TERM_BYTES), F.lit(0)).alias("b")).first()["b"]
    n = 1 + weight // BLOCK_BYTES
    dealt = stored(found.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)))) if n > 1 else found.withColumn("block", F.lit(0))
    for i in range(n):
        rows = dealt.where(F.col("block") == i).select("item_id", "term").collect()
        rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
        if rows:
            yield _block(rows)


def _postings(vocabulary: Broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.value.get
        width = len(vocabulary.value)
        for batch in batches:
            length, hits, counts = [], [], []
            for text in batch.column(1).to_pylist():
                own = terms(text)
                length.append(len(own))
                before = len(hits)
                hits.extend([p for p in map(place, own) if p is not None])
                counts.append(len(hits) - before)
            row = np.repeat(np.arange(len(length), dtype=np.int64), counts)
            pairs, times = np.unique(row * width + np.array(hits, np.int64), return_counts=True)
            row, term = pairs // width, pairs % width
            offsets = pa.array(np.searchsorted(row, np.arange(len(length) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(length, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                ["doc_id", "n", "term", "tf"],
            )

    return run


def _holders(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=width)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(held[term])], ["term", "df"])

    return run


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each occurrence count adds per unit of weight, in 64-bit integers; always below 10^6."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * n_docs) // n_terms
    return (SCALE * tf) // (1000 * tf + 8 * m)


@dataclass
class _Tile:
    """Up to ITEM_TILE items: ``first`` of them, how many, the places of their terms in the vocabulary, and their weights as a matrix."""

    first: int
    n: int
    term: np.ndarray
    weight: np.ndarray


def _tiles(block: Block, weights: np.ndarray) -> Iterator[_Tile]:
    for first in range(0, len(block.ids), ITEM_TILE):
        a, b = np.searchsorted(block.item, [first, first + ITEM_TILE])
        n = min(ITEM_TILE, len(block.ids) - first)
        term, place = np.unique(block.term[a:b], return_inverse=True)
        weight = np.zeros((len(term), n))
        weight[place, block.item[a:b] - first] = weights[block.term[a:b]]
        yield _Tile(first, n, term, weight)


def exact_width(weights: np.ndarray) -> int:
    """Terms of a tile so that no sum of weight times impact can reach 2^53."""
    most = max(1, int(weights.max(initial=0))) * (SCALE // 1000)
    return max(1, min(TERM_TILE, (EXACT - 1) // most))


def tile_scores(row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, tile: _Tile, width: int) -> np.ndarray:
    """Scores (documents by items) from places (row, term, impact)."""
    at = np.searchsorted(tile.term, term)
    mine = at < len(tile.term)
    mine[mine] = tile.term[at[mine]] == term[mine]
    row, at, impact = row[mine], at[mine], impact[mine]
    total = np.zeros((n_docs, tile.n), np.int64)
    present, column = np.unique(at, return_inverse=True)
    for start in range(0, len(present), width):
        part = present[start:start + width]
        inside = (column >= start) & (column < start + len(part))
        left = np.zeros((n_docs, len(part)))
        left[row[inside], column[inside] - start] = impact[inside]
        total += (left @ tile.weight[part]).astype(np.int64)
    return total


class Best:
    """The best ``k`` rows of each of ``n`` items so far: higher scores first, then smaller ids, rows without an id last."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.least = np.ones(n, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, no id, id

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
            self.least = np.maximum(self.least, kth)
        doc, item = np.nonzero(scores >= self.least)
        new = (item, scores[doc, item], no_id[doc], ids[doc])
        self.rows = [np.concatenate(pair) for pair in zip(self.rows, new)]
        if len(self.rows[0]) > 4 * self.n * self.k:
            self.cut()

    def cut(self) -> None:
        item, score, no_id, ids = self.rows
        order = np.lexsort((ids, no_id, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[rank < self.k]
        self.rows = [column[order] for column in self.rows]
        self._raise_limits()

    def _raise_limits(self) -> None:
        item, score = self.rows[0], self.rows[1]
        count = np.bincount(item, minlength=self.n)
        lowest = np.full(self.n, np.iinfo(np.int64).max)
        np.minimum.at(lowest, item, score)
        self.least = np.where(count >= self.k, np.maximum(self.least, lowest), self.least)


_FOUND = "item int, score long, no_id long, doc_id long"


def _ranked(block: Broadcast, weights: Broadcast, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Best] = {}
        width = exact_width(weights.value)
        for batch in batches:
            no_id = batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column(0).fill_null(0).to_numpy()
            length = batch.column(1).to_numpy()
            offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            term = batch.column(2).flatten().to_numpy().astype(np.int64)
            tf = batch.column(3).flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(length)), np.diff(offsets))
            impact = impacts(tf, length[row], n_docs, n_terms)
            for tile in _tiles(block.value, weights.value):
                best = held.setdefault(tile.first, Best(tile.n, k))
                for a in range(0, len(length), DOC_TILE):
                    b = min(a + DOC_TILE, len(length))
                    x, y = offsets[a], offsets[b]
                    best.add(tile_scores(row[x:y] - a, term[x:y], impact[x:y], b - a, tile, width), no_id[a:b], ids[a:b])
        for first, best in held.items():
            best.cut()
            item, score, no_id, ids = best.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array((item + first).astype(np.int32)), pa.array(score), pa.array(no_id), pa.array(ids)],
                [c.split()[0] for c in _FOUND.split(", ")],
            )

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """Ranks from 1. Tasks' rows of an item are cut in salted groups first, so no task gets them all."""
    order = [F.desc("score"), F.asc("no_id"), F.asc("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _search(spark: SparkSession, texts: DataFrame, block: Block, kind, k: int) -> DataFrame:
    context = spark.sparkContext
    vocabulary = context.broadcast(block.vocabulary)
    postings = stored(texts.mapInArrow(_postings(vocabulary), "doc_id long, n long, term array<int>, tf array<int>"))
    vocabulary.unpersist()
    total = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    width = len(block.vocabulary)
    # At most one row of the block's vocabulary each.
    holders = postings.select("term").mapInArrow(_holders(width), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(width, np.int64)
    for r in holders:
        df[r["term"]] = r["df"]
    weights = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    sent, by_term = context.broadcast(Block([None] * len(block.ids), {}, block.item, block.term)), context.broadcast(weights)
    hit = postings.where(F.size("term") > 0)
    found = stored(hit.mapInArrow(_ranked(sent, by_term, total["docs"], max(1, total["terms"]), k), _FOUND))
    sent.unpersist()
    by_term.unpersist()
    names = StructType([StructField("item", LongType()), StructField("item_id", kind)])
    listed = spark.createDataFrame(list(enumerate(block.ids)), names)
    ranked = _top(found, k).join(listed, "item")
    no_id = F.col("no_id") == 1
    return ranked.select("item_id", F.col("rank").cast("int"), F.when(~no_id, F.col("doc_id")).alias("doc_id"), "score")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each item, from rank 1.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are not looked at. A term is a run of ASCII letters, digits and
    characters beyond ASCII, with A-Z lower-cased. Equal scores go by doc_id, rows without one last. Null and empty texts have no
    terms: such documents are in no result and don't count, such items have no rows. Rows that repeat a document are documents of their own;
    rows that repeat an item_id are one item with the terms of all. An empty table gives no rows. An item's terms are counted once.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))
    kind = items.schema["item_id"].dataType
    parts = [_search(spark, texts, block, kind, k) for block in item_blocks(items)]
    if not parts:
        schema = StructType([StructField("item_id", kind), *StructType.fromDDL("rank int, doc_id long, score long").fields])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)
