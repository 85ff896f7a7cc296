"""Similarity join on word five-grams by chosen paths.

A document is the set of its hashed five-word shingles; documents with equal sets are one class. Each class has a vector of min-hash
values, and a *path* takes sampled tokens of the set: the shingle that is the smallest under a hash function. Two sets choose the same
token with a chance that is their similarity, so similar sets stay together while they are split. Each run splits all sets by the
first token of its path, splits the buckets that are too large by the next, and so on; runs have functions of their own, and
there are as many as the wanted recall takes for a pair at the threshold whose buckets had to be split to the last level.

Small buckets are compared all with all; a bucket that is still large at the last level is cut into blocks, and
each pair of blocks is a group. Comparing is in two steps: sketches first, and then, for the sets that have a likely partner,
the whole sets, so that a link is exact. A pair that shares buckets in several runs counts in the first of them, which both
members can tell from the buckets they carry. Groups give one row per set, its number of links and a root, never the pairs.
Roots are joined into classes by passing the smallest name along, over stored tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from ebbtide.llm.common import arrow_limits, join_hot, packed, stored, text_or_empty, unpacked

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
LEVELS = 3
SMALL = 128
BLOCK = 512
HASHES = 64
#: Equal sketch places, of HASHES, from which a pair is looked at: six deviations below the mean at the threshold. All runs test the same
#: sketch, so what it misses must be far less than what the runs may miss.
SLACK = 6.0
#: Words whose hashes a worker keeps: so many, and none that is longer.
CACHE_WORDS, CACHED_BYTES = 300_000, 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(8)
_FACTORS = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, HASHES, dtype=np.uint64)


def least_places(threshold: float) -> int:
    """Equal sketch places that a pair needs to be looked at."""
    return max(0, math.ceil(HASHES * threshold - SLACK * math.sqrt(HASHES * threshold * (1 - threshold))))


def sketch_miss(threshold: float = THRESHOLD) -> float:
    """The chance that the sketches of a pair at the threshold have too few equal places."""
    return sum(math.comb(HASHES, k) * threshold**k * (1 - threshold) ** (HASHES - k) for k in range(least_places(threshold)))


def runs_for(recall: float, threshold: float = THRESHOLD, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold is found with this chance: its sketches pass, and it has met even if each run splits it
    to the last level."""
    missed = 1 - recall / (1 - sketch_miss(threshold))
    if missed <= 0:
        raise ValueError(f"sketches of {HASHES} places don't reach a recall of {recall}")
    return math.ceil(math.log(missed) / math.log(1 - threshold**levels))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


def shingles(text: bytes, words: WordHashes) -> np.ndarray:
    """Distinct hashed five-grams of the words between ASCII white space, A-Z lower-cased; a shorter text is one shingle."""
    listed = text.lower().split()
    if not listed:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, listed), np.uint64, len(listed))
    n = min(WORDS, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = out * _STEP + h[k:k + len(out)]
    return np.unique(_mixed(out))


def min_hashes(tokens: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.uint64(2**64 - 1))
    for a in range(0, len(tokens), 2048):
        part = tokens[a:a + 2048, None] * _FACTORS + _SHIFTS
        best = np.minimum(best, (part ^ (part >> np.uint64(29))).min(axis=0))
    return _mixed(best)


def paths(values: np.ndarray, runs: int, levels: int) -> np.ndarray:
    """Names of the buckets of each run and level, run by run."""
    out = np.zeros((runs, levels), np.uint64)
    name = np.arange(1, runs + 1, dtype=np.uint64) * _STEP
    for level in range(levels):
        # More runs than values give some values a second use, at another level.
        chosen = values[(np.arange(runs) * levels + level) % HASHES]
        name = _mixed(name * np.uint64(3) + chosen)
        out[:, level] = name
    return out.ravel()


def _records(runs: int, levels: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            size, f1, f2, keys, sketches = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, words)
                size.append(len(s))
                f1.append(int(s.sum(dtype=np.uint64)))
                f2.append(int(np.bitwise_xor.reduce(_mixed(s + _STEP))) if len(s) else 0)
                values = min_hashes(s)
                keys.append(paths(values, runs, levels))
                sketches.append((values & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            offsets = np.arange(len(size) + 1, dtype=np.int32) * (runs * levels)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(size, pa.int64()), pa.array(np.array(f1, np.uint64).view(np.int64)),
                    pa.array(np.array(f2, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(sketches, pa.binary()), batch.column(2),
                ],
                ["doc_id", "size", "sid", "check", "keys", "sketch", "row"],
            )

    return run


def _groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, list]]:
    """The rows of one group after the other, as rows come sorted by ``group``."""
    held: dict[str, list] = {n: [] for n in names}
    last = None
    for batch in batches:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
        group = columns["group"].to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if last is not None and group[a] != last:
                yield held
                held = {n: [] for n in names}
            last = group[a]
            for n in names:
                held[n].extend(columns[n].slice(a, b - a).to_pylist())
    if last is not None:
        yield held


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the smallest row of its component."""
    n = len(linked)
    label = np.arange(n)
    while True:
        best = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _open_pairs(run: int, block: np.ndarray, seen: np.ndarray, cross: bool) -> np.ndarray:
    """Pairs that this group has to decide: of two blocks if it joins two, and of no earlier bucket in common."""
    n = len(block)
    mine = ~np.eye(n, dtype=bool)
    if cross:
        mine &= block[:, None] != block[None, :]
    for r in range(run):
        mine &= (seen[:, None, r] != seen[None, :, r]) | (seen[:, None, r] == 0)
    return mine


_LIKELY = "sid long, group long, run int, blk int, cross boolean"
_MEMBER = ["group", "sid", "run", "blk", "cross", "size", "seen"]


def _likely(threshold: float) -> Callable:
    least = least_places(threshold)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for g in _groups(batches, [*_MEMBER, "sketch"]):
            n = len(g["sid"])
            if n < 2:
                continue
            sketch = np.frombuffer(b"".join(g["sketch"]), np.uint16).reshape(n, HASHES)
            size = np.array(g["size"], float)
            near = np.zeros((n, n), bool)
            for i in range(n):
                near[i] = ((sketch == sketch[i]).sum(axis=1) >= least) & (np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i]))
            near &= _open_pairs(g["run"][0], np.array(g["blk"]), np.array(g["seen"], np.int64), g["cross"][0])
            roots = _roots(near)
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                # Each set of likely partners is a group of its own from here.
                name = xxhash.xxh3_64_intdigest(b"%d %d" % (g["group"][0], roots[i])) - (1 << 63)
                out.append((g["sid"][i], name, g["run"][0], g["blk"][i], g["cross"][0]))
            if len(out) > 20_000:
                yield _likely_batch(out)
                out = []
        yield _likely_batch(out)

    return run


def _likely_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in range(5)]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _LIKELY.split(", ")])


_SETS = "sid long, copies long, seen array<long>, group long, run int, blk int, cross boolean, tokens binary"


def _whole_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, sid, copies, seen, places) -> a row with the whole set for each place where it is needed."""
    words = WordHashes()
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
    names = [c.split()[0] for c in _SETS.split(", ")]
    for batch in batches:
        out = []
        for text, sid, copies, seen, places in zip(*(batch.column(i).to_pylist() for i in range(5))):
            found = shingles(text, words)
            if int(found.sum(dtype=np.uint64)) != sid % 2**64:
                continue  # another text under the same id
            tokens = found.tobytes()
            out += [(sid, copies, seen, p["group"], p["run"], p["blk"], p["cross"], tokens) for p in places]
        for a in range(0, max(1, len(out)), 256):
            columns = list(zip(*out[a:a + 256])) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Tokens that each two sets have in common, by products of 0-1 matrices over slices of the tokens."""
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, column = owner[common], column[common]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = 2048
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        total += part @ part.T
    return np.rint(total).astype(np.int64)


_LINKS = "sid long, links long, root long"


def _links(threshold: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for g in _groups(batches, ["group", "sid", "run", "blk", "cross", "copies", "seen", "tokens"]):
            if len(set(g["sid"])) < len(g["sid"]):  # rows that repeat an id and its text
                first = [g["sid"].index(x) for x in dict.fromkeys(g["sid"])]
                g = {name: [column[i] for i in first] for name, column in g.items()}
            n = len(g["sid"])
            if n > 1:
                sets = [np.frombuffer(t, np.uint64) for t in g["tokens"]]
                size = np.array([len(s) for s in sets])
                both = shared_counts(sets)
                linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
                linked &= _open_pairs(g["run"][0], np.array(g["blk"]), np.array(g["seen"], np.int64), g["cross"][0])
                roots, links = _roots(linked), linked @ np.array(g["copies"], np.int64)
                out += [(g["sid"][i], int(links[i]), g["sid"][roots[i]]) for i in np.flatnonzero(linked.any(axis=1)).tolist()]
            if len(out) > 20_000:
                yield _links_batch(out)
                out = []
        yield _links_batch(out)

    return run


def _links_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["sid", "links", "root"])


def path_buckets(sets: DataFrame, runs: int, levels: int = LEVELS, small: int = SMALL) -> DataFrame:
    """(sid, run, k, n): the bucket of each set in each run in which it isn't alone. sets: (sid, keys)."""
    every = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    live = sets.select("sid", every, "keys").select("sid", "run", F.slice("keys", F.col("run") * levels + 1, levels).alias("path"))
    found = None
    for level in range(levels):
        keyed = live.withColumn("k", F.element_at("path", level + 1))
        counts = stored(keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        sized = join_hot(keyed, counts, "k", "n", F.xxhash64("sid", "run"))
        if level + 1 < levels:
            sized = stored(sized.where("n > 1"))
            done = sized.where(F.col("n") <= small)
            live = sized.where(F.col("n") > small).select("sid", "run", "path")
        else:
            done = sized.where("n > 1")
        done = done.select("sid", "run", "k", "n")
        found = done if found is None else found.unionByName(done)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(sid, label) of every set in an edge (sid, root): the smallest name of its component."""
    both = stored(edges.select("sid", "root").union(edges.select(F.col("root"), F.col("sid"))).distinct())
    labels = stored(both.groupBy("sid").agg(F.least(F.col("sid"), F.min("root")).alias("label")))
    while True:
        sent = both.join(labels.withColumnRenamed("sid", "root"), "root").groupBy("sid").agg(F.min("label").alias("m"))
        lower = labels.join(sent, "sid").select("sid", "label", F.least("label", "m").alias("new"))
        # One step along the label's own label halves long chains.
        jump = labels.select(F.col("sid").alias("new"), F.col("label").alias("far"))
        moved = lower.join(jump, "new", "left").select("sid", "label", F.least("new", "far").alias("new"))
        moved = stored(moved)
        changed = moved.where("label <> new").limit(1).count()
        labels = moved.select("sid", F.col("new").alias("label"))
        if not changed:
            return labels


def similarity_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """The record of each row of ``docs`` (doc_id, sid: the name of its set), and what is known of each set that is not alone.

    The second table has a row (sid, label, class_id, copies, n_links) for each set that has copies or links; a label is a name of the class.
    """
    arrow_limits(docs.sparkSession)
    runs = runs_for(recall, threshold)
    # Rows without an id are found again by their text.
    doc_id, text = F.col("doc_id").cast("long"), text_or_empty().cast("binary")
    texts = docs.select(doc_id.alias("doc_id"), text.alias("t"), F.coalesce(doc_id, F.xxhash64(text)).alias("row"))
    kinds = "doc_id long, size long, sid long, check long, keys array<long>, sketch binary, row long"
    records = stored(texts.mapInArrow(_records(runs, LEVELS), kinds))
    classes = stored(
        records.where("size > 0").groupBy("sid", "size", "check").agg(
            F.min("doc_id").alias("rep"), F.min("row").alias("at"), F.count(F.lit(1)).alias("copies")
        )
    )
    sets = stored(
        records.where("size > 0").dropDuplicates(["sid"]).select("sid", "size", "keys", "sketch")
    )
    buckets = stored(path_buckets(sets, runs))
    seen = buckets.groupBy("sid").agg(F.map_from_entries(F.collect_list(F.struct("run", "k"))).alias("_at")).select(
        "sid", F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.col("_at")[r], F.lit(0).cast("long"))).alias("seen")
    )
    facts = stored(seen.join(sets.select("sid", "size", "sketch"), "sid"))
    # A large bucket is cut into blocks; each set goes to all pairs of blocks that hold its own.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = buckets.withColumn("_nb", blocks).withColumn("blk", F.expr("cast(pmod(xxhash64(sid, 'block'), _nb) as int)"))
    paired = placed.select("sid", "run", "k", "blk", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_o"))
    grouped = paired.select(
        "sid", "run", "blk", (F.col("blk") != F.col("_o")).alias("cross"),
        F.xxhash64("k", F.least("blk", "_o"), F.greatest("blk", "_o")).alias("group"),
    )
    members = grouped.join(facts, "sid").select(*_MEMBER, "sketch")
    likely = stored(members.repartition("group").sortWithinPartitions("group").mapInArrow(_likely(threshold), _LIKELY))
    # Texts of the representatives that have a likely partner are read again, for whole sets.
    needed = likely.groupBy("sid").agg(F.collect_list(F.struct("group", "run", "blk", "cross")).alias("places"))
    wanted = needed.join(facts.select("sid", "seen"), "sid").join(classes.select("sid", "at", "copies"), "sid")
    by_text = texts.join(wanted, F.col("row") == F.col("at")).select("t", "sid", "copies", "seen", "places")
    whole = by_text.mapInArrow(_whole_sets, _SETS)
    found = stored(whole.repartition("group").sortWithinPartitions("group").mapInArrow(_links(threshold), _LINKS))
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    labels = components(found.where("sid <> root").select("sid", "root"))
    named = classes.join(links, "sid", "left").join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    told = stored(
        named.where("copies > 1 or links > 0").join(smallest, "label")
        .select("sid", "label", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return records.select("doc_id", "sid"), told


@arrow_udf(LongType())
def _set_name(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    words = WordHashes()
    for part in parts:
        sums = [int(shingles(t, words).sum(dtype=np.uint64)) for t in part.to_pylist()]
        yield pa.array(np.array(sums, np.uint64).view(np.int64))


def with_classes(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Adds class_id, copies, n_links to rows that have a doc_id and a sid; a set may belong to a third of the rows."""
    spread = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("row"))
    found = join_hot(rows, told, "sid", "copies", spread)
    return (
        found.withColumn("class_id", F.when(F.col("copies").isNull(), F.col("doc_id").cast("long")).otherwise(F.col("class_id")))
        .withColumn("copies", F.coalesce("copies", F.lit(1)).cast("long"))
        .withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
    )


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The columns of ``docs`` and class_id, copies, n_links.

    class_id is the smallest doc_id of all documents that chains of links join, copies the number of rows with the same set, and n_links
    the number of other rows whose set has a Jaccard similarity of ``threshold`` or more (rows with the same set among them). Words stand
    between ASCII white space; a text of fewer than five is one shingle; a text without words (null, empty) has no links and is
    its own class. Rows that repeat an id are rows of their own. Null ids are never the smallest. An empty table gives no rows. Columns of
    ``docs`` with the three names are replaced.
    """
    needed = ["doc_id", "text"]
    return unpacked(_classed(docs, threshold, recall), docs, needed, {c: F.col(c) for c in ("class_id", "copies", "n_links")})


def _classed(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    _, told = similarity_classes(docs, threshold, recall)
    return with_classes(packed(docs, ["doc_id", "text"], sid=_set_name(text_or_empty().cast("binary"))), told)


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each class of ``jaccard_join``, of the smallest doc_id, with the columns of ``docs``.

    Of rows that repeat this id, and of a class without any id, one stays. Texts without words are classes of their own and all stay. An empty
    table gives no rows.
    """
    found = _classed(docs, threshold, recall)
    first = found.where(F.col("doc_id").cast("long").eqNullSafe(F.col("class_id")))
    # Candidates of a class are combined in each task before they meet.
    chosen = first.where("label is not null").dropDuplicates(["label"]).unionByName(first.where("label is null"))
    return unpacked(chosen, docs, ["doc_id", "text"], {})
