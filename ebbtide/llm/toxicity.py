"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Words are the runs between ASCII white space. From labelled documents come *terms*, whole words and prefixes, that toxic documents hold
far more often than clean ones. A word with such a term is a *hit* with a grade of evidence; in a toxic document it is labelled
as part of a toxic span, any other word as outside. The field has two states; its features are the grade, capitals, and nearness of
the last hit, and its transitions make spans. All words without evidence have the same potentials, so the forward and
backward sums pass a stretch of them by a power of one 2 x 2 matrix: exact, and the cost goes with the hits.

A document's score is a logistic function of the marginals of its hits (the largest, their sum, their density), fitted on the same rows.
Only texts are inputs. Fitting uses at most ``fit_rows`` labelled rows, those with the smallest hash of the id; scoring reads all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ebbtide.llm.common import arrow_limits, packed, stored, text_or_empty, unpacked

FIT_ROWS = 30_000
FOLDS = 5
MOST_TERMS = 4_096
PREFIXES = (4, 5, 6)
LEAST_TOXIC_DOCS = 5
LEAST_Z = 5.0
CLEAN_BEFORE = 20
#: Lower bounds, in log odds, of the grades 1, 2, ... of evidence.
GRADES = (1.0, 2.0, 3.0, 4.0, 6.0)
NEAR = 3
#: Runs whose codes a worker keeps: so many, and none that is longer.
CACHE_WORDS, CACHED_BYTES = 300_000, 64
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(rb"[^\x20\x09-\x0d]+")
_SCORED = (
    "struct<score: double, words: long, hits: long, largest: double, "
    "spans: array<struct<start: long, end: long, probability: double>>>"
)


#: Scripts that put no blanks between words: Thai, Lao, Burmese, Khmer, kana and Han. Their runs are whole sentences.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
PARTS = (2, 3, 4)


def terms_of(word: str) -> Iterator[str]:
    """The word, its beginnings, and in scripts without blanks every short part of it."""
    if _UNSPACED.search(word):
        for n in PARTS:
            yield from (f"~{word[i:i + n]}" for i in range(len(word) - n + 1))
        return
    yield f"={word}"
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n]


def _term_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each term, by label; flushed when the table is large, as the sums are added up later."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(_WORD.findall(text.lower()))
            for term in {t for w in words for t in terms_of(w)}:
                counts.setdefault(term, [0, 0])[toxic] += 1
        if len(counts) > 400_000:
            yield _counts_batch(counts)
            counts = {}
    yield _counts_batch(counts)


def _counts_batch(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))],
        ["term", "clean", "toxic"],
    )


def learn_terms(sample: DataFrame, most: int = MOST_TERMS) -> dict[str, int]:
    """At most ``most`` terms with their grade. sample: (text, toxic)."""
    rows = sample.select(text_or_empty().alias("t"), F.col("toxic").cast("int"))
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("k")).first()
    toxic, clean = float(size["k"]), float(size["n"] - size["k"])
    sums = rows.mapInArrow(_term_counts, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("k")
    )
    odds = F.log((F.col("k") + 0.5) / F.lit(toxic + 1)) - F.log((F.col("c") + 0.5) / F.lit(clean + 1))
    noise = F.sqrt(1 / (F.col("k") + 0.5) + 1 / (F.col("c") + 0.5))
    strong = (
        sums.where(F.col("k") >= LEAST_TOXIC_DOCS).withColumn("odds", odds).withColumn("z", F.col("odds") / noise)
        .where((F.col("odds") >= GRADES[0]) & ((F.col("z") >= LEAST_Z) | ((F.col("c") == 0) & (F.col("odds") >= GRADES[3]))))
        .orderBy(F.desc("z"), "term").limit(most)
    )
    return {r["term"]: sum(r["odds"] >= g for g in GRADES) for r in strong.collect()}


class Words(dict):
    """Codes of runs: 0 without evidence, else twice the grade, one more with a capital."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, run: bytes) -> int:
        text = run.decode("utf-8", "replace")
        grade = max((self.terms.get(t, 0) for w in _WORD.findall(text.lower()) for t in terms_of(w)), default=0)
        code = 2 * grade + (grade > 0 and text[:1].isupper())
        if len(run) <= CACHED_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[run] = code
        return code


def hits_of(text: bytes, words: Words) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of runs, and the places and codes of the hits among them."""
    runs = text.split()
    codes = np.fromiter(map(words.__getitem__, runs), np.int8, len(runs))
    at = np.flatnonzero(codes)
    return len(runs), at, codes[at]


#: Parameters: one for each grade, capital, near, the toxic state without evidence, into, inside, out of a span.
_N = len(GRADES) + 6
CAPITAL, CLOSE, PLAIN, INTO, INSIDE, OUT = range(len(GRADES), _N)


def features(at: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Rows of the features that a hit has in the toxic state."""
    x = np.zeros((len(at), _N))
    x[np.arange(len(at)), codes // 2 - 1] = 1
    x[:, CAPITAL] = codes % 2
    x[1:, CLOSE] = np.diff(at) <= NEAR
    return x


def _step(theta: np.ndarray, unary) -> list:
    """Transfer matrix into a word whose toxic state has this log potential, row by row."""
    e = np.exp
    return [[1.0, e(theta[INTO] + unary)], [e(theta[OUT]), e(theta[INSIDE] + unary)]]


def plain_powers(theta: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transfer matrix over each number of words without evidence, scaled, and the logs of the scales."""
    base, log_base = np.array(_step(theta, theta[PLAIN])), 0.0
    out, logs, left = np.tile(np.eye(2), (len(gaps), 1, 1)), np.zeros(len(gaps)), gaps.copy()
    while left.any():
        odd = left % 2 == 1
        out[odd] = out[odd] @ base
        logs[odd] += log_base
        scale = out.max(axis=(1, 2))
        out /= scale[:, None, None]
        logs += np.log(scale)
        base, log_base = base @ base, 2 * log_base
        top = base.max()
        base, log_base = base / top, log_base + math.log(top)
        left //= 2
    return out, logs


class Sample:
    """Labelled documents as arrays: the hits of all documents one after the other, longest documents first."""

    def __init__(self, docs: list[tuple[int, list[int], list[int], int]]):
        docs = sorted(docs, key=lambda d: -len(d[1]))
        self.n = np.array([d[0] for d in docs], np.int64)
        self.toxic = np.array([d[3] for d in docs], bool)
        self.hits = np.array([len(d[1]) for d in docs], np.int64)
        self.start = np.cumsum(self.hits) - self.hits
        at = [np.array(d[1], np.int64) for d in docs]
        self.x = np.concatenate([np.zeros((0, _N)), *(features(a, np.array(d[2], np.int64)) for a, d in zip(at, docs) if len(a))])
        before = [np.diff(a, prepend=-1) - 1 for a in at]
        self.gap = np.concatenate([np.zeros(0, np.int64), *before]).astype(np.int64)
        self.tail = np.array([d[0] - 1 - (a[-1] if len(a) else -1) for a, d in zip(at, docs)], np.int64)
        self.all_gaps, inverse = np.unique(np.concatenate([self.gap, self.tail]), return_inverse=True)
        self.gap_at, self.tail_at = inverse[: len(self.gap)], inverse[len(self.gap):]
        self.gold = self._gold_counts()

    def _gold_counts(self) -> np.ndarray:
        marked = np.repeat(self.toxic, self.hits)
        total = self.x[marked].sum(axis=0)
        first = np.zeros(len(self.gap), bool)
        first[self.start[self.hits > 0]] = True
        joined = marked & ~first & (self.gap == 0)
        total[INSIDE] += joined.sum()
        total[INTO] += (marked & ~joined).sum()
        # A span is left unless its last hit ends the text.
        total[OUT] += (marked & ~joined).sum() - (self.toxic & (self.hits > 0) & (self.tail == 0)).sum()
        return total

    def log_z(self, theta: np.ndarray) -> float:
        powers, logs = plain_powers(theta, self.all_gaps)
        alpha, total = np.tile([1.0, 0.0], (len(self.n), 1)), 0.0
        unary = np.exp(self.x @ theta)
        into, inside, out = (math.exp(theta[i]) for i in (INTO, INSIDE, OUT))
        for k in range(int(self.hits.max(initial=0))):
            live = int(np.searchsorted(-self.hits, -k, side="left"))
            row = self.start[:live] + k
            a = np.einsum("di,dij->dj", alpha[:live], powers[self.gap_at[row]])
            a = np.stack([a[:, 0] + a[:, 1] * out, (a[:, 0] * into + a[:, 1] * inside) * unary[row]], axis=1)
            scale = a.sum(axis=1)
            alpha[:live] = a / scale[:, None]
            total += np.log(scale).sum() + logs[self.gap_at[row]].sum()
        end = np.einsum("di,dij->d", alpha, powers[self.tail_at])
        return total + np.log(end).sum() + logs[self.tail_at].sum()


def fit_field(sample: Sample, rounds: int = 60, ridge: float = 1.0) -> np.ndarray:
    """Penalised maximum likelihood by BFGS; the gradient of log Z comes from differences, as there are few parameters."""

    def loss(theta: np.ndarray) -> float:
        return (sample.log_z(theta) - sample.gold @ theta + ridge * theta @ theta) / max(1, len(sample.n))

    def slope(theta: np.ndarray) -> np.ndarray:
        step = 1e-4
        return np.array([(loss(theta + step * e) - loss(theta - step * e)) / (2 * step) for e in np.eye(_N)])

    theta = np.zeros(_N)
    theta[[PLAIN, INTO]] = -3.0, -2.0
    value, g, inverse = loss(theta), slope(theta), np.eye(_N)
    for _ in range(rounds):
        move, rate = -inverse @ g, 1.0
        if g @ move > 0:
            move, inverse = -g, np.eye(_N)
        while rate > 1e-6 and not loss(np.clip(theta + rate * move, -15, 15)) <= value + 1e-4 * rate * (g @ move):
            rate /= 2
        if rate <= 1e-6:
            break
        new = np.clip(theta + rate * move, -15, 15)
        g_new = slope(new)
        s, y = new - theta, g_new - g
        value_new = loss(new)
        if s @ y > 1e-12:
            r = 1 / (s @ y)
            left = np.eye(_N) - r * np.outer(s, y)
            inverse = left @ inverse @ left.T + r * np.outer(s, s)
        done = value - value_new < 1e-7
        theta, g, value = new, g_new, value_new
        if done:
            break
    return theta


class Tagger:
    """Marginals of the hits of one document by forward and backward sums."""

    def __init__(self, theta: np.ndarray):
        self.theta = theta
        self._powers: dict[int, list] = {}

    def _power(self, gap: int) -> list:
        if gap not in self._powers:
            if len(self._powers) > 50_000:
                self._powers.clear()
            self._powers[gap] = plain_powers(self.theta, np.array([gap]))[0][0].tolist()
        return self._powers[gap]

    def marginals(self, n: int, at: np.ndarray, codes: np.ndarray) -> list[float]:
        if not len(at):
            return []
        unary = np.exp(features(at, codes.astype(np.int64)) @ self.theta).tolist()
        into, inside, out = (math.exp(self.theta[i]) for i in (INTO, INSIDE, OUT))
        steps, last = [], -1
        for place, u in zip(at.tolist(), unary):
            p = self._power(place - last - 1)
            # Over the plain words and then into the hit.
            steps.append([[r[0] + r[1] * out, (r[0] * into + r[1] * inside) * u] for r in p])
            last = place
        forward, a = [], (1.0, 0.0)
        for m in steps:
            a = (a[0] * m[0][0] + a[1] * m[1][0], a[0] * m[0][1] + a[1] * m[1][1])
            total = a[0] + a[1]
            a = (a[0] / total, a[1] / total)
            forward.append(a)
        p = self._power(n - 1 - last)
        b, found = (p[0][0] + p[0][1], p[1][0] + p[1][1]), []
        for i in range(len(steps) - 1, -1, -1):
            o, t = forward[i][0] * b[0], forward[i][1] * b[1]
            found.append(t / (o + t))
            m = steps[i]
            b = (m[0][0] * b[0] + m[0][1] * b[1], m[1][0] * b[0] + m[1][1] * b[1])
            total = b[0] + b[1]
            b = (b[0] / total, b[1] / total)
        return found[::-1]


def summary(n: int, marginals: list[float]) -> list[float]:
    """What the document score is made of: a constant, the largest marginal, the sum and the density of all."""
    largest, total = max(marginals, default=0.0), sum(marginals)
    return [1.0, largest, math.log1p(total), math.log1p(1000 * total / max(n, 20))]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + keep
        w = w - np.linalg.solve(curve, x.T @ (p - y) + keep @ w)
    return w


@dataclass
class ToxicityModel:
    terms: dict[str, int]
    theta: np.ndarray
    weights: np.ndarray

    def score(self, n: int, marginals: list[float]) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(summary(n, marginals), self.weights), -30, 30))))


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, most_terms: int = MOST_TERMS) -> ToxicityModel:
    """Fits on labelled rows outside fold 0. labels: (doc_id, toxic); repeated labels: the largest counts; null labels are left out.

    Two bounds: at most ``fit_rows`` labelled rows are fitted on, and of the terms that set their toxic texts apart at most ``most_terms`` are learnt,
    those with the clearest difference; scoring looks at every word of every text.
    Equal texts count once. Without labelled rows of both kinds no term is learnt and all scores are near the share of toxic rows.
    """
    arrow_limits(docs.sparkSession)
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # Ids and labels only, at most fit_rows of them: small enough to send to all tasks.
    chosen = usable.where(fold_of(F.col("doc_id")) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    chosen = stored(chosen)
    joined = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = stored(joined.groupBy(F.sha2("text", 256).alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("h"))
    terms = learn_terms(sample, most_terms)

    def compressed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(terms)
        for batch in batches:
            rows = [(*hits_of(t, words), y) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tolist() for r in rows], pa.list_(pa.int64())),
                    pa.array([r[2].tolist() for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.int32()),
                ],
                ["n", "at", "codes", "toxic"],
            )

    short = sample.select(F.col("text").cast("binary").alias("t"), "toxic").mapInArrow(
        compressed, "n long, at array<long>, codes array<long>, toxic int"
    )
    rows = [tuple(r) for r in short.collect()]
    rows.sort()
    if not rows:
        return ToxicityModel({}, np.zeros(_N), np.array([-2.0, 0, 0, 0]))
    theta = fit_field(Sample(rows)) if terms else np.zeros(_N)
    tagger = Tagger(theta)
    x = np.array([summary(n, tagger.marginals(n, np.array(at, np.int64), np.array(codes, np.int64))) for n, at, codes, _ in rows])
    # A few clean texts without evidence beside the labelled ones: a handful of toxic labels must not condemn all texts.
    x = np.vstack([x, np.tile(summary(100, []), (CLEAN_BEFORE, 1))])
    y = np.array([r[3] for r in rows] + [0] * CLEAN_BEFORE, float)
    return ToxicityModel(terms, theta, fit_logistic(x, y))


def _spans(text: bytes, at: np.ndarray, marginals: list[float]) -> list[dict]:
    """Code points of the hits that are more likely toxic than not, end exclusive; neighbouring hits are one span."""
    wanted = {int(a): p for a, p in zip(at, marginals) if p >= 0.5}
    if not wanted:
        return []
    spans, chars, seen, last = [], 0, 0, -2
    for place, run in enumerate(_RUN.finditer(text)):
        if place not in wanted:
            continue
        chars += len(text[seen:run.start()].decode("utf-8", "replace"))
        start, chars = chars, chars + len(run.group().decode("utf-8", "replace"))
        seen = run.end()
        if place == last + 1:
            spans[-1].update(end=chars, probability=max(spans[-1]["probability"], wanted[place]))
        else:
            spans.append({"start": start, "end": chars, "probability": wanted[place]})
        last = place
    return spans


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The columns of ``docs`` and score, predicted, toxic_spans (code points of the text, end exclusive, with a probability).

    Null texts count as empty; an empty text gets the score of a text without evidence. Columns of ``docs`` with the three names are
    replaced.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    sent = spark.sparkContext.broadcast(model)  # at most MOST_TERMS terms

    @arrow_udf(_SCORED)
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, tagger = Words(sent.value.terms), Tagger(sent.value.theta)
        for part in parts:
            rows = []
            for text in part.to_pylist():
                n, at, codes = hits_of(text, words)
                p = tagger.marginals(n, at, codes)
                rows.append(
                    {
                        "score": sent.value.score(n, p), "words": n, "hits": len(at), "largest": max(p, default=0.0),
                        "spans": _spans(text, at, p),
                    }
                )
            kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
            yield pa.array(
                rows,
                pa.struct([
                    ("score", pa.float64()), ("words", pa.int64()), ("hits", pa.int64()), ("largest", pa.float64()),
                    ("spans", pa.list_(kind)),
                ]),
            )

    marked = packed(docs, [], found=scored(text_or_empty().cast("binary")))
    score = F.col("found.score")
    return unpacked(marked, docs, [], {"score": score, "predicted": (score >= 0.5).cast("int"), "toxic_spans": F.col("found.spans")})
