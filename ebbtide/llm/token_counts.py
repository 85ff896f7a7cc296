"""Token counts of whole texts, with a two-tier look-up of pre-token lengths on the map side.

The tokenizer works on each run of characters between ASCII white space by itself, so a text has as many tokens as its runs
have. Tier one is a compact hash table from the frequent runs to their numbers of tokens; it is broadcast, and its number of entries is
bounded by a parameter. Tier two is a cache in each Python worker: runs it has not seen are encoded by the library in
batches. No pre-token is shuffled. Which runs are frequent is counted over all rows: each task keeps a bounded summary of
its own counts, one row, and summaries are merged in rounds, sixteen into one, into a bounded summary each time. The tables decide what is
looked up and what is encoded, never the count.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ebbtide.llm.common import arrow_limits, stored, text_or_empty

VOCABULARY = "word_bpe_49k.json"
FREQUENT = 32_768
#: Entries of a task's summary; what is rarer in that task than all of these does not reach the frequent table.
SUMMARY = 2_048
SUMMARY_ROOM = 200_000
#: Runs that a worker keeps: so many, and none that is longer. Text without white space has long runs, each of little use again.
CACHE_ENTRIES, CACHED_BYTES = 400_000, 64
MERGED = 16
LIMIT = 2048
#: A mark after a word of plain letters is a token of its own.
_MARKS = (b".", b",")


class Lengths(dict):
    """Numbers of tokens by run; ``frequent`` stays, the rest is a cache that starts anew when it is full."""

    def __init__(self, path: str, frequent: dict[bytes, int], room: int = CACHE_ENTRIES):
        # Spark runs a worker on each core; threads inside a worker would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__(frequent)
        self.frequent, self.room = frequent, room
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.marks = dict(zip(_MARKS, self.encode(list(_MARKS))))

    def encode(self, runs: list[bytes]) -> list[int]:
        texts = [r.decode("utf-8", "replace") for r in runs]
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, runs: set[bytes]) -> None:
        missed = [r for r in runs if r not in self]
        marked = [r for r in missed if r.endswith(_MARKS) and r[:-1].isalpha()]
        whole = list({r for r in (*missed, *(r[:-1] for r in marked)) if r not in self}.difference(marked))
        self.update(zip(whole, self.encode(whole)))
        for run in marked:
            self[run] = self[run[:-1]] + self.marks[run[-1:]]

    def count_all(self, texts: list[bytes]) -> list[int]:
        """The numbers of tokens of a batch of texts; what the table lacks is encoded together."""
        if len(self) > self.room + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        counts: list[int | None] = []
        missed: set[bytes] = set()
        for text in texts:
            runs = text.split()  # bytes: at ASCII white space only
            try:
                counts.append(sum(map(self.__getitem__, runs)))
            except KeyError:
                counts.append(None)
                missed.update(r for r in runs if r not in self)
        if missed:
            self.learn(missed)
            counts = [sum(map(self.__getitem__, t.split())) if n is None else n for n, t in zip(counts, texts)]
            for run in [r for r in missed if len(r) > CACHED_BYTES]:
                self.pop(run, None)
                self.pop(run[:-1], None)
        return counts


_workers: dict[tuple, Lengths] = {}


def _worker(path: str, version: str, frequent: dict[bytes, int]) -> Lengths:
    """One table for each Python worker, kept from task to task."""
    key = (path, version)
    if key not in _workers:
        _workers.clear()
        _workers[key] = Lengths(path, frequent)
    return _workers[key]


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(text.split())
            if len(counts) > SUMMARY_ROOM:
                counts = Counter(dict(counts.most_common(SUMMARY_ROOM // 4)))
    yield _summary([(r, n) for r, n in counts.most_common(SUMMARY) if len(r) <= CACHED_BYTES])


_SUMMARY = "runs array<binary>, counts array<long>"


def _summary(top: list[tuple[bytes, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([[r for r, _ in top]], pa.list_(pa.binary())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))], ["runs", "counts"]
    )


def _most(counts: Counter[bytes], most: int) -> list[tuple[bytes, int]]:
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]


def _merged(most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for runs, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for r, n in zip(runs, numbers):
                    counts[r] += n
        yield _summary(_most(counts, most))

    return run


def frequent_runs(docs: DataFrame, most: int = FREQUENT) -> list[bytes]:
    """At most ``most`` runs, by count over the summaries of all tasks; the last ``MERGED`` summaries come to the driver."""
    arrow_limits(docs.sparkSession)
    rows = stored(docs.select(text_or_empty().cast("binary").alias("t")).mapInArrow(_summaries, _SUMMARY))
    n = rows.count()
    while n > MERGED:
        n = -(-n // MERGED)
        rows = stored(rows.repartition(n).mapInArrow(_merged(most), _SUMMARY))
    counts: Counter[bytes] = Counter()
    for row in rows.collect():
        for r, number in zip(row["runs"], row["counts"]):
            counts[bytes(r)] += number
    return [r for r, _ in _most(counts, most)]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, most_frequent: int = FREQUENT) -> DataFrame:
    """The columns of ``docs`` and n_bytes, n_tokens, over_limit.

    Counted as the library does for the vocabulary at ``path`` (the same on all executors), without added tokens, truncation or
    padding; the vocabulary must drop white space, as ``word_bpe_49k.json`` does. Null texts count as empty: 0 and 0. Columns of ``docs``
    with the three names are replaced; repeated rows are counted each.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    runs = frequent_runs(docs, most_frequent)
    table = spark.sparkContext.broadcast(dict(zip(runs, Lengths(path, {}).encode(runs))))
    version = str(hash(tuple(sorted(runs))))

    @arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = _worker(path, version, table.value)
        for part in parts:
            yield pa.array(lengths.count_all(part.to_pylist()), pa.int64())

    base = docs.drop("n_bytes", "n_tokens", "over_limit")
    text = text_or_empty()
    return (
        base.withColumn("n_bytes", F.octet_length(text).cast("long"))
        .withColumn("n_tokens", count(text.cast("binary")))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


