"""Periodic runs of words, found with a suffix automaton whose link tree has link-cut access.

The words of a stretch are the letters. In the tree of suffix links the path from the state of a prefix to the root holds all suffixes of that
prefix, the longest first. Words are appended one after the other: ``access`` makes the path of the prefix one preferred path, and
so recolours it with the place of its end. What it cuts through are segments of earlier colours: a segment with colour ``e`` and a deepest
state of length ``l`` says that the suffixes up to length ``l`` ended last at ``e``. With ``p = now - e <= l`` the two places
overlap or touch, which is a square of period ``p``; and as no longer suffix ended there, the stretch of period ``p`` starts exactly
at ``now - p - l + 1``. The period is the smallest, since a smaller one would have been a later end. While words are appended, the square of a run
shows at every word from its second period on, so the last one gives its end.

Most words of prose can't lie in a run of four periods. ``stretches`` finds, without losing one, the stretches that can: in a run of
period ``q`` each pair of neighbouring words (but the first ``q``) stood at most ``q`` words before, so there are ``3q - 1`` such
pairs in a row. The automaton reads these stretches; ``runs_of(words, prune=False)`` reads all, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ebbtide.llm.common import arrow_limits, packed, text_or_empty, unpacked

LEAST_WORDS, LEAST_PERIODS = 6, 4
_FAR = np.int64(1) << np.int64(62)
Run = tuple[int, int, int]


def link_tree(word: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """The suffix automaton of ``word``: length and suffix link of each state (1 is the root, 0 none), and the state of each prefix."""
    length, link, after = [-1, 0], [0, 0], [{}, {}]
    prefixes, last = [], 1
    for c in word:
        new = len(length)
        length.append(length[last] + 1)
        link.append(1)
        after.append({})
        p = last
        while p and c not in after[p]:
            after[p][c] = new
            p = link[p]
        if p:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                after.append(after[q].copy())
                while p and after[p].get(c) == q:
                    after[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
        prefixes.append(new)
    return length, link, prefixes


class LinkCut:
    """A rooted tree cut into preferred paths, each a splay tree by depth. A path has one colour, kept at the root of its splay tree."""

    def __init__(self, parents: list[int]):
        n = len(parents)
        self.parent, self.left, self.right = list(parents), [0] * n, [0] * n
        self.colour = [-1] * n

    def _splay(self, x: int) -> None:
        parent, left, right, colour = self.parent, self.left, self.right, self.colour
        while True:
            y = parent[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = parent[y]
            y_left, y_right = z and left[z] == y, z and right[z] == y
            # Only the colour of a splay tree's root counts; it goes along with whoever gets there.
            if y_left or y_right:
                colour[x] = colour[z]
                # Same side twice: the parent goes up first.
                if (left[y] == x) == bool(y_left):
                    self._rotate(y)
                else:
                    self._rotate(x)
            else:
                colour[x] = colour[y]
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        y = parent[x]
        z = parent[y]
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        parent[x] = z
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            parent[inner] = y
        parent[y] = x

    def access(self, x: int, now: int) -> list[tuple[int, int]]:
        """Recolours the path from ``x`` to the root; gives (colour, deepest node) of the coloured segments on it, the deepest first."""
        parent, right, colour = self.parent, self.right, self.colour
        found, below = [], 0
        while x:
            self._splay(x)
            old, cut = colour[x], right[x]
            if cut:
                colour[cut] = old
            right[x] = below
            if old >= 0:
                found.append((old, x))
            below, x = x, parent[x]
        colour[below] = now
        return found


def _runs_of_stretch(word: Sequence[int], first: int, found: dict[tuple[int, int], int]) -> None:
    length, link, prefixes = link_tree(word)
    tree = LinkCut(link)
    for now, state in enumerate(prefixes):
        for end, deepest in tree.access(state, now):
            period, common = now - end, length[deepest]
            whole = period + common
            if whole >= LEAST_WORDS and whole >= LEAST_PERIODS * period:
                found[first + now - whole + 1, period] = first + now


def pair_distances(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each word the distance to the last place where it followed the same word, in the same text; far where there is none.

    ``start`` says for each word where its text begins.
    """
    n = len(words)
    distance = np.full(n, _FAR)
    if n < 2:
        return distance
    pair = words[1:] * np.int64(0x5851F42D4C957F2D) + (words[:-1] ^ (words[:-1] >> np.int64(31)))
    order = np.argsort(pair, kind="stable")
    same = pair[order[1:]] == pair[order[:-1]]
    here, before = order[1:][same] + 1, order[:-1][same] + 1
    # The pair itself must lie in one text, and so must its last place.
    inside = before - 1 >= start[here]
    distance[here[inside]] = (here - before)[inside]
    return distance


def stretches(words: np.ndarray, start: np.ndarray) -> list[tuple[int, int]]:
    """[a, b) of the flat words that hold every run: joined where they overlap, none across texts."""
    distance = pair_distances(words, start)
    near = np.flatnonzero(distance < _FAR)
    if not len(near):
        return []
    found = []
    most = int(distance[near].max())
    reach = 1
    while True:  # periods from reach to 2 * reach - 1
        widest = 2 * reach - 1
        at = near[distance[near] <= widest]
        if len(at):
            cuts = np.flatnonzero((np.diff(at) != 1) | (start[at[1:]] != start[at[:-1]])) + 1
            a, b = at[np.r_[0, cuts]], at[np.r_[cuts - 1, len(at) - 1]] + 1
            long = b - a >= max(LEAST_WORDS - 2, (LEAST_PERIODS - 1) * reach - 1)
            found += zip(np.maximum(a[long] - widest - 1, start[a[long]]).tolist(), b[long].tolist())
        if widest >= most:
            break
        reach *= 2
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1] and start[a] == start[out[-1][0]]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _numbered(words: Sequence[bytes]) -> list[int]:
    places: dict[bytes, int] = {}
    return [places.setdefault(w, len(places)) for w in words]


def runs_of_texts(texts: list[list[bytes]], prune: bool = True) -> list[list[Run]]:
    """(start, length, period) of the runs of each text, by start and period."""
    size = [len(t) for t in texts]
    first = np.cumsum([0, *size])
    found: list[dict] = [{} for _ in texts]
    if prune:
        flat = [h for t in texts for h in map(hash, t)]
        parts = stretches(np.array(flat, np.int64), np.repeat(first[:-1], size))
        owner = np.searchsorted(first, [a for a, _ in parts], side="right") - 1
        places = [(int(t), a - int(first[t]), b - int(first[t])) for t, (a, b) in zip(owner, parts)]
    else:
        places = [(i, 0, n) for i, n in enumerate(size)]
    for i, a, b in places:
        _runs_of_stretch(_numbered(texts[i][a:b]), a, found[i])
    return [sorted((a, end - a + 1, period) for (a, period), end in f.items()) for f in found]


def runs_of(words: list[bytes], prune: bool = True) -> list[Run]:
    return runs_of_texts([words], prune)[0]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run repeats, joined by one blank."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep).tolist())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))
_FOUND = StructType([StructField("runs", _RUNS), StructField("collapsed", StringType())])
#: Words that are looked at together.
_TOGETHER = 1 << 18


@arrow_udf(_FOUND)
def _found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in parts:
        runs, texts, held, n = [], [], [], 0
        for value in part:
            held.append(value.as_py().split())
            n += len(held[-1])
            if n >= _TOGETHER:
                _settle(held, runs, texts)
                held, n = [], 0
        _settle(held, runs, texts)
        listed = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(_RUN))
        yield pa.StructArray.from_arrays([listed, pa.array(texts, pa.string())], ["runs", "collapsed"])


def _settle(held: list[list[bytes]], runs: list, texts: list) -> None:
    found = runs_of_texts(held)
    runs.extend(found)
    texts.extend(collapsed(words, own).decode() for words, own in zip(held, found))


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` and n_runs, runs, collapsed.

    Words stand between ASCII white space. A run is a stretch with smallest period q, at least 6 words and 4 q long, that can't be extended; ``runs``
    lists (start, length, period) by start and period, places counted from 0 in words. ``collapsed`` is the text's words joined by one blank,
    without those that any run holds after its first q. A null or empty text has no words, no runs and an empty ``collapsed``. Rows are
    looked at one by one, so repeated rows and ids, null ids and empty tables need no rule. ``text`` is used instead of the column of that name.
    Columns of ``docs`` with the three names are replaced. A stretch that may hold a run takes about half a kilobyte a word in its task.
    """
    arrow_limits(docs.sparkSession)
    given = text_or_empty() if text is None else F.coalesce(text, F.lit(""))
    both = packed(docs, [], found=_found(given.cast("binary")))
    runs = F.col("found.runs")
    return unpacked(both, docs, [], {"n_runs": F.size(runs).cast("long"), "runs": runs, "collapsed": F.col("found.collapsed")})


def strongest(runs: Column) -> Column:
    """Of a list of runs the one with the greatest length per period, exactly; ties go to the smallest start, then period; null of none."""
    def better(a: Column, b: Column) -> Column:
        new, old = b["length"] * a["period"], a["length"] * b["period"]
        return a.isNull() | (new > old) | ((new == old) & ((b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))))

    empty = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, empty, lambda a, b: F.when(better(a, b), b).otherwise(a))


def run_text(runs: Column) -> Column:
    """Each run as ``start,length,period`` and a line feed."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
