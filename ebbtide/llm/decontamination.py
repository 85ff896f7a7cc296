"""Benchmark passages in documents, also with other numbers, names or units in them.

Texts become templates: numbers, units and names inside a sentence are replaced by typed placeholders, all else is
lower-cased without marks at the ends. Windows of a template are hashed; those of the benchmark are the build side of a hash join, those
of the documents probe it batch by batch. A window that is mostly placeholders says little as a template and is hashed both ways; as a template it counts
where its whole alignment holds enough different words or slots that repeat a value. Matched
windows of a document and an item that lie on one diagonal are an alignment. The slots it covers are checked: one value of the item must
stand for one value in the document, all the way, where slots of other values at the ends of an alignment may be left out. Of an alignment
that fails this, the verbatim runs of a window or more are kept, and count where they are long enough together. An item is
found where the alignments cover enough of it.

The build side is sent to the tasks in blocks of items of bounded size, and all documents are run against each block, so a
benchmark of any size is joined whole. Documents are neither shuffled nor joined with each other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

from ebbtide.llm.common import arrow_limits, text_or_empty

WINDOW = 8
LEAST_SHARE = 0.5
LONG_RUN = 20
JOINED_WORDS = 3
BLOCK_BYTES = 16 << 20
#: Runs whose codes a worker keeps: so many, and none that is longer.
CACHE_WORDS, CACHED_BYTES = 300_000, 64
#: Words that count as units.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ounce ounces pound pounds ton tons ml l liter "
    "liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents usd eur percent degree degrees mph kmh watt watts volt volts".split()
)
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»…"
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(%|[a-z]{1,3})?")
_ENDS = (b".", b"!", b"?", b":", b";", b'."', b".)")
_RUN = re.compile(rb"[^\x20\x09-\x0d]+")
_MARK = {kind: xxhash.xxh3_64_intdigest(f"<{kind}>".encode()) for kind in ("number", "unit", "name")}
_BASE = np.uint64(0x9E3779B97F4A7C15)


def canonical(run: str, starts: bool) -> tuple[str, str]:
    """(kind, word) of a run; the kind is number, unit, name or empty. A word of marks only is empty."""
    word = run.strip(_EDGES)
    if not word:
        return "", ""
    small = word.lower()
    if _NUMBER.fullmatch(small):
        return "number", small
    if small in UNITS:
        return "unit", small
    return ("name" if word[0].isupper() and not starts else ""), small


_KINDS = ("", "number", "unit", "name")


class Templates(dict):
    """Row numbers of runs in arrays: code and kind inside a sentence and at its start, hash of the value, whether it ends a sentence."""

    def __init__(self):
        super().__init__()
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.inside, self.first, self.value = (np.zeros(1024, np.uint64) for _ in range(3))
        self.kind_inside, self.kind_first, self.ends, self.n = np.zeros(1024, np.int8), np.zeros(1024, np.int8), np.zeros(1024, bool), 0

    def _grow(self) -> None:
        for name in ("inside", "first", "value", "kind_inside", "kind_first", "ends"):
            column = getattr(self, name)
            setattr(self, name, np.concatenate([column, np.zeros_like(column)]))

    def learn(self, runs: list[bytes]) -> None:
        """Gives the runs row numbers; their codes are written together."""
        while self.n + len(runs) > len(self.inside):
            self._grow()
        facts = list(zip(*map(_facts, runs)))
        rows = slice(self.n, self.n + len(runs))
        for name, column in zip(("inside", "first", "value", "kind_inside", "kind_first", "ends"), facts):
            getattr(self, name)[rows] = np.array(column, getattr(self, name).dtype)
        self.update(zip(runs, range(self.n, self.n + len(runs))))
        self.n += len(runs)

    def text(self, text: bytes) -> Text:
        """The runs of a text and what their codes are."""
        if self.n > CACHE_WORDS:
            self._reset()
        runs = text.split()
        try:
            at = np.fromiter(map(self.__getitem__, runs), np.int64, len(runs))
        except KeyError:
            missed = list({r for r in runs if r not in self})
            self.learn(missed)
            at = np.fromiter(map(self.__getitem__, runs), np.int64, len(runs))
            for run in missed:
                if len(run) > CACHED_BYTES:
                    del self[run]
        return Text(self, runs, at)


_UNIT_RUNS = frozenset(u.encode() for u in UNITS)
_FIRST_OF_NUMBERS = frozenset("+-$€£0123456789")


def _facts(run: bytes) -> tuple[int, int, int, int, int, bool]:
    """Code inside a sentence and at its start, hash of the value, kind inside and at the start, whether it ends a sentence."""
    if run.isalpha() and run.islower() and run not in _UNIT_RUNS:
        # Most runs: small ASCII letters only, the same everywhere.
        h = xxhash.xxh3_64_intdigest(run) | 1
        return h, h, h, 0, 0, False
    word, ends = run.decode("utf-8", "replace").strip(_EDGES), run.endswith(_ENDS)
    if not word:
        return 0, 0, 0, 0, 0, ends
    small = word.lower()
    h = xxhash.xxh3_64_intdigest(small.encode("utf-8", "replace")) | 1
    if (small[0] in _FIRST_OF_NUMBERS or small[0].isdecimal()) and _NUMBER.fullmatch(small):
        return _MARK["number"], _MARK["number"], h, 1, 1, ends
    if small in UNITS:
        return _MARK["unit"], _MARK["unit"], h, 2, 2, ends
    return (_MARK["name"], h, h, 3, 0, ends) if word[0].isupper() else (h, h, h, 0, 0, ends)


class View:
    """One reading of a text: its codes and values in order, and the first and last run of each place."""

    def __init__(self, text: Text, names_at_starts: bool, joined: bool):
        table, at = text.table, text.at
        code, kind = table.inside[at], table.kind_inside[at]
        if not names_at_starts:
            starts = np.ones(len(at), bool)
            starts[1:] = table.ends[at[:-1]]
            code, kind = np.where(starts, table.first[at], code), np.where(starts, table.kind_first[at], kind)
        words = np.flatnonzero(code)
        code, kind, value = code[words], kind[words], table.value[at[words]]
        self.runs, self.first, self.last, self.codes, self.values, self.kinds = text.runs, words, words, code, value, kind
        if joined and len(words):
            head = np.ones(len(words), bool)
            head[1:] = (kind[1:] == 0) | (kind[1:] != kind[:-1])
            if not head.all():
                places = np.flatnonzero(head)
                within = np.arange(len(words)) - np.repeat(places, np.diff(np.append(places, len(words))))
                self.first, self.codes, self.kinds = words[places], code[places], kind[places]
                self.last = words[np.append(places[1:], len(words)) - 1]
                self.values = np.add.reduceat(value * (within.astype(np.uint64) * np.uint64(2) + np.uint64(1)), places)

    def slots(self, places: Iterable[int]) -> list[tuple[str, str]]:
        """Kind and value of the given places."""
        out = []
        for p in places:
            found = (canonical(r.decode("utf-8", "replace"), True)[1] for r in self.runs[self.first[p]:self.last[p] + 1])
            out.append((_KINDS[self.kinds[p]], " ".join(w for w in found if w)))
        return out


#: How texts are read: capitals at a sentence's start as words or as names, and neighbouring slots of one kind apart or as one.
READINGS = ((False, False), (True, True))


@dataclass
class Text:
    table: Templates
    runs: list[bytes]
    at: np.ndarray

    def views(self) -> list[View]:
        return [View(self, *reading) for reading in READINGS]


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A polynomial over each ``length`` neighbours, built from those of half the length."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    out = _polynomials(hashes, length)
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def _polynomials(hashes: np.ndarray, length: int) -> np.ndarray:
    if length == 1:
        return hashes
    half = length // 2
    low, n = _polynomials(hashes, half), len(hashes) - length + 1
    out = low[:n] * np.uint64(pow(int(_BASE), half, 1 << 64)) + low[half:half + n]
    return out if length % 2 == 0 else out * _BASE + hashes[length - 1:length - 1 + n]


class Benchmark:
    """The build side: window hashes in order, each with its item and place, by reading, window length and whether values are hashed."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.window, self.ids = window, []
        self.slots: list[list] = [[] for _ in READINGS]
        self.codes: list[list] = [[] for _ in READINGS]
        rows: dict[tuple, list] = {}
        templates = Templates()
        for item_id, text in items:
            views = templates.text(text.encode("utf-8", "replace")).views()
            if not len(views[0].codes):
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            for reading, view in enumerate(views):
                self._add(reading, number, view, rows)
        self.tables: list[dict] = [{} for _ in READINGS]
        for (reading, *kind), found in rows.items():
            found.sort()
            h = np.array([f[0] for f in found], np.uint64)
            maybe = np.zeros(1 << 20, bool)
            maybe[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables[reading][tuple(kind)] = (h, np.array([f[1:] for f in found], np.int64), maybe)

    def _add(self, reading: int, number: int, view: View, rows: dict[tuple, list]) -> None:
        slots = view.slots(range(len(view.codes)))
        length = min(self.window, len(view.codes))
        literal = np.array([kind == "" for kind, _ in slots], np.int64)
        words = np.convolve(literal, np.ones(length, np.int64), "valid")
        # Joined slots leave few places, and two words between them say too little.
        enough = (words * 2 >= length) & (words >= (JOINED_WORDS if READINGS[reading][1] else 0))
        self.slots[reading].append(slots)
        self.codes[reading].append((view.codes, length, enough))
        # Only these places can speak for an alignment; windows without any are found from their neighbours.
        times = Counter(value for kind, value in slots if kind)
        speaks = np.array([kind == "" or times[value] > 1 for kind, value in slots], np.int64)
        some = np.convolve(speaks, np.ones(length, np.int64), "valid") > 0
        # What has fewer words than half a window is told by its values alone.
        short = 2 * length < self.window
        for exact, codes, wanted in ((False, view.codes, (enough | some) & (not short)), (True, view.values, ~enough | short)):
            own = window_hashes(codes, length)
            for place in np.flatnonzero(wanted).tolist():
                rows.setdefault((reading, length, exact), []).append((int(own[place]), number, place))

    def matches(self, reading: int, view: View) -> Iterator[tuple[int, int, int, int, bool]]:
        """(item, place in the item, place in the document, length, whether it counts by itself) of each pair of equal windows."""
        for (length, exact), (table, owners, maybe) in self.tables[reading].items():
            own = window_hashes(view.values if exact else view.codes, length)
            at = np.flatnonzero(maybe[(own >> np.uint64(44)).astype(np.int64)])
            low = np.searchsorted(table, own[at], "left")
            high = np.searchsorted(table, own[at], "right")
            for place, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                for item, start in owners[a:b].tolist():
                    yield item, start, place, length, exact or bool(self.codes[reading][item][2][start])

    def template_places(self, reading: int, item: int, shift: int, hashes: np.ndarray) -> set[int]:
        """Places of the item in windows of its template that the document has at this shift."""
        own, length, _ = self.codes[reading][item]
        if 2 * length < self.window:
            return set()
        low, high = max(0, -shift), min(len(own), len(hashes) - shift)
        differ = np.flatnonzero(own[low:high] != hashes[low + shift:high + shift]) + low
        found: set[int] = set()
        for a, b in zip([low, *(differ + 1).tolist()], [*differ.tolist(), high]):
            if b - a >= length:
                found.update(range(a, b))
        return found


def _consistent(both: list[tuple[int, str, str, str]]) -> bool:
    """Whether one value stands for one value in all slots. both: (place, kind, value of the item, value of the document)."""
    seen: dict[str, str] = {}
    return all(seen.setdefault(a, b) == b for _, kind, a, b in both if kind)


def _trimmed(both: list[tuple[int, str, str, str]]) -> list[tuple[int, str, str, str]]:
    """Without the slots of other values at both ends: what follows a passage may fit its template by chance."""
    first, last = 0, len(both)
    while last > first and both[last - 1][1] and both[last - 1][2] != both[last - 1][3]:
        last -= 1
    while first < last and both[first][1] and both[first][2] != both[first][3]:
        first += 1
    return both[first:last]


def _tells(both: list[tuple[int, str, str, str]], length: int) -> bool:
    """Whether different words and slots that repeat a value are as many as a single window would need words."""
    words = {a for _, kind, a, _ in both if not kind}
    slots = [a for _, kind, a, _ in both if kind]
    return 2 * (len(words) + len(slots) - len(set(slots))) >= length


def _accepted(both: list[tuple[int, str, str, str]]) -> list[tuple[int, str, str, str]]:
    """All or the trimmed alignment, whichever is consistent; else nothing."""
    if _consistent(both):
        return both
    both = _trimmed(both)
    return both if _consistent(both) else []


def _verbatim(both: list[tuple[int, str, str, str]], least: int) -> list[int]:
    """Places in runs of at least ``least`` places without a gap or another value."""
    kept: list[int] = []
    run: list[int] = []
    for s, kind, a, b in both:
        same = not kind or a == b
        if run and (not same or s != run[-1] + 1):
            kept += run if len(run) >= least else []
            run = []
        if same:
            run.append(s)
    return kept + (run if len(run) >= least else [])


def leaks_of(text: bytes, bench: Benchmark, templates: Templates, share: float, long_run: int) -> list[tuple]:
    """(item id, words covered, share, kind, start, end) of each item that a text holds; offsets are code points, end exclusive.

    An item that several readings find is told by the first of them.
    """
    found: dict[int, tuple] = {}
    for reading, view in enumerate(templates.text(text).views()):
        for item, covered, part, kind, first, last in _leaks_in(reading, view, bench, share, long_run):
            found.setdefault(item, (covered, part, kind, first, last))
    if not found:
        return []
    places = sorted({p for *_, first, last in found.values() for p in (first, last)})
    spans = _code_points(text, places)
    return [(bench.ids[item], covered, part, kind, spans[first][0], spans[last][1]) for item, (covered, part, kind, first, last) in found.items()]


def _code_points(text: bytes, wanted: list[int]) -> dict[int, tuple[int, int]]:
    """Start and end of the runs with the given numbers."""
    out, at, chars, waiting = {}, 0, 0, iter(wanted)
    place = next(waiting, None)
    for number, run in enumerate(_RUN.finditer(text)):
        if number != place:
            continue
        start = chars + len(text[at:run.start()].decode("utf-8", "replace"))
        end = start + len(run.group().decode("utf-8", "replace"))
        out[place] = (start, end)
        at, chars = run.end(), end
        if (place := next(waiting, None)) is None:
            break
    return out


def _leaks_in(reading: int, view: View, bench: Benchmark, share: float, long_run: int) -> Iterator[tuple]:
    """(item, words covered, share, kind, first run, last run) of the items that one reading of a text holds."""
    hashes = view.codes
    # Per item and shift the places that windows cover by themselves, and whether others may add to them.
    lines: dict[int, dict[int, set[int]]] = {}
    for item, start, place, length, alone in bench.matches(reading, view):
        spots = lines.setdefault(item, {}).setdefault(place - start, set())
        if alone:
            spots.update(range(start, start + length))
    for item, diagonals in lines.items():
        wanted, covered, changed, places = bench.slots[reading][item], set(), False, []
        least = bench.codes[reading][item][1]
        torn, torn_places = set(), []
        wide = {shift: spots | bench.template_places(reading, item, shift, hashes) for shift, spots in diagonals.items()}
        possible = sum(map(len, wide.values()))
        if possible < share * len(wanted) and possible < long_run:
            continue
        for shift, spots in diagonals.items():
            every = wide[shift]
            if any(wanted[s][0] for s in every):
                ordered = sorted(every)
                own = view.slots([s + shift for s in ordered])
                whole = [(s, *wanted[s], value) for s, (_, value) in zip(ordered, own)]
                both = _accepted(whole) if len(every) > len(spots) else []
                if not both or not _tells(both, least):
                    both = _accepted([x for x in whole if x[0] in spots])
                if not both:
                    if spots and (kept := _verbatim(whole, bench.window)):
                        torn.update(kept)
                        torn_places += [kept[0] + shift, kept[-1] + shift]
                    continue
                changed |= any(kind and a != b for _, kind, a, b in both)
                spots = {s for s, *_ in both}
            if not spots:
                continue
            covered |= spots
            places += [min(spots) + shift, max(spots) + shift]
        if len(covered | torn) >= long_run:
            covered, places, changed = covered | torn, places + torn_places, changed or bool(torn)
        part = len(covered) / len(wanted)
        if covered and (part >= share or len(covered) >= long_run):
            yield item, len(covered), part, "changed" if changed else "same", int(view.first[min(places)]), int(view.last[max(places)])


def _build_sides(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator:
    """The benchmark in broadcast blocks of about ``block_bytes`` of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = items.where(F.expr(f"pmod(xxhash64(item_id, text), {blocks})") == block) if blocks > 1 else items
        yield spark.sparkContext.broadcast(Benchmark([tuple(r) for r in part.collect()], window))


def _free_of(sent: Broadcast, share: float, long_run: int) -> Callable:
    @arrow_udf(BooleanType())
    def free(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        templates, bench = Templates(), sent.value
        for part in parts:
            yield pa.array([not leaks_of(t, bench, templates, share, long_run) for t in part.to_pylist()], pa.bool_())

    return free


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = LEAST_SHARE, long_run: int = LONG_RUN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` in which ``benchmark_leaks`` finds no item; each row is judged by its own text, so repeated rows stay or go together.

    Null and empty texts hold nothing and stay, whatever their other columns; null and empty items are found nowhere. An empty table gives no rows.
    """
    arrow_limits(docs.sparkSession)
    clean = docs
    for sent in _build_sides(benchmark, window, block_bytes):
        clean = clean.where(_free_of(sent, share, long_run)(text_or_empty().cast("binary")))
    return clean


_LEAKS = "doc_id long, item_id long, words_found long, share double, kind string, start long, end long"


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = LEAST_SHARE, long_run: int = LONG_RUN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document row and item found in it: doc_id, item_id, words_found, share, kind (same, changed), start, end.

    Every item with a word is searched. Items shorter than a window are found as a whole, those of fewer words than half a window with their own
    values only (a single word wherever it stands). Texts are read in two ways: capitals at the start of a sentence as words and
    slots of one kind side by side apart, or as names and as one, so a name may become one of more words. An item counts where
    at least ``share`` of its words or ``long_run`` words are covered. Verbatim runs of an alignment with inconsistent slots count towards
    ``long_run`` only. Alignments with few words and few repeated slots are found with the item's values only.
    Null texts hold nothing, as documents and as items; repeated rows are searched each, repeated items are found each.
    """
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))
    found = None
    for sent in _build_sides(benchmark, window, block_bytes):

        def probe(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            templates, bench = Templates(), sent.value
            for batch in batches:
                out = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    out += [(doc, *leak) for leak in leaks_of(text, bench, templates, share, long_run)]
                columns = list(zip(*out)) if out else [[] for _ in range(7)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.int64(), pa.int64())
                names = [c.split()[0] for c in _LEAKS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        one = rows.mapInArrow(probe, _LEAKS)
        found = one if found is None else found.unionByName(one)
    return found
