"""Text quality by Naive Bayes support vectors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import frugal, ship
from tessera.llm.kernels import LOWER, NOT_SPACE, mix, slices, utf8, word_bounds, word_hashes

#: Labelled rows that a model is fitted on at most: those of the smallest hashes of their ids.
SAMPLE_ROWS = 4_000
#: Width of the feature space: hashed word n-grams, then hashed shape n-grams.
WORD_BITS, SHAPE_BITS = 17, 16
DIMENSIONS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
ACCEPT = 0.7
_U = np.uint64

# What a byte says of its word's shape: lower case, upper case, digit, beyond ASCII, other.
_CLASS = np.full(256, 16, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 4, 8


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Distinct n-grams of texts: (first row, feature numbers, bounds of each row), a slice of rows at a time.

    N-grams run over words (one and two, lower-cased) and over word shapes (one to three): the kinds of
    characters in a word, its last mark, its length class, and whether it repeats the word before.
    """
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part, cuts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends = word_bounds(part, cuts, NOT_SPACE)
        n = len(starts)
        at = np.searchsorted(starts, cuts)
        row = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(at))
        words = word_hashes(LOWER[part], starts, ends)
        if n:
            kinds = np.bitwise_or.reduceat(np.where(NOT_SPACE[part], _CLASS[part], 0), starts).astype(_U)
            last = part[ends - 1]
            last = np.where(_CLASS[last] == 16, last, 0).astype(_U)
            again = np.zeros(n, _U)
            again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
            size = np.minimum((ends - starts) // 4, 6).astype(_U)
            shapes = mix(kinds | last << _U(8) | again << _U(16) | size << _U(17) | (_CLASS[part[starts]].astype(_U) << _U(20)))
        else:
            shapes = words
        grams = []
        for base, bits, first, most in ((0, WORD_BITS, words, 2), (1 << WORD_BITS, SHAPE_BITS, shapes, 3)):
            h = first
            for k in range(most):
                if k:
                    h = mix(h[:-1] * _U(0x9FB21C651E98DF25) + first[k:]) if len(h) > 1 else h[:0]
                m = len(h)
                whole = row[:m] == row[k : k + m]
                grams.append((row[:m] << _U(18) | (h >> _U(64 - bits)) + _U(base))[whole])
        found = np.concatenate(grams) if n else np.zeros(0, _U)
        found.sort()
        keep = np.ones(len(found), bool)
        keep[1:] = found[1:] != found[:-1]
        found = found[keep]
        yield i, (found & _U((1 << 18) - 1)).astype(np.int64), np.searchsorted(found >> _U(18), np.arange(j - i + 1, dtype=_U))


@dataclass
class Model:
    """score = 1 / (1 + exp(slope * margin + shift)); margin = weights over distinct features / sqrt(their number) + bias."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for i, found, bounds in features(column):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[found], dtype=np.float64)])
            n = np.diff(bounds)
            out[i : i + len(n)] = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.sqrt(np.maximum(n, 1)) + self.bias
        return 1 / (1 + np.exp(np.clip(self.slope * out + self.shift, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """ln of the ratio of a feature's smoothed share in the two classes."""
    shares = []
    for label in (1, 0):
        own = [r for r, k in zip(rows, y) if k == label]
        n = np.bincount(np.concatenate(own) if own else np.zeros(0, np.int64), minlength=DIMENSIONS) + alpha
        shares.append(np.log(n / n.sum()))
    return shares[0] - shares[1]


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, c: float = 1.0, rounds: int = 8, seed: int = 7) -> tuple[np.ndarray, float]:
    """The linear hinge-loss model over ratio-scaled unit rows by dual coordinate descent; the bias is a feature of value 1."""
    values = [ratios[r] / np.sqrt(max(len(r), 1)) for r in rows]
    square = np.array([v @ v + 1 for v in values])
    sign, dual = np.where(y == 1, 1.0, -1.0), np.zeros(len(rows))
    w, b, order = np.zeros(DIMENSIONS), 0.0, np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            slope = sign[i] * (float(np.sum(w[r] * v)) + b) - 1  # no BLAS: its threads cost more than such short rows
            new = min(max(dual[i] - slope / square[i], 0.0), c)
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                w[r] += step * v
                b += step
                dual[i] = new
    return w, b


def sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through held-out margins, by Newton steps on smoothed targets."""
    up, down = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 0.0, float(np.log((down + 1) / (up + 1)))
    x = np.stack([margins, np.ones(len(y))])

    def loss(a: float, b: float) -> float:
        f = a * margins + b
        return float(np.sum(np.logaddexp(0, f) - (1 - t) * f))

    best = loss(a, b)
    for _ in range(100):
        p = 1 / (1 + np.exp(np.clip(a * margins + b, -500, 500)))
        g = x @ (t - p)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-9 * np.eye(2), g)
        size = 1.0
        while size > 1e-8 and not loss(a - size * step[0], b - size * step[1]) < best - 1e-12:
            size /= 2
        if size <= 1e-8:
            break
        a, b = a - size * step[0], b - size * step[1]
        best = loss(a, b)
    return float(a), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray, folds: int = 3) -> Model:
    """A model whose scores are calibrated on margins of folds that did not see the row. One class or none: a constant."""
    if len(set(y.tolist())) < 2:
        share = (float(y.sum()) + 1) / (len(y) + 2)
        return Model(np.zeros(DIMENSIONS, np.float32), 0.0, 0.0, float(np.log((1 - share) / share)))
    fold, margins = np.arange(len(y)) % folds, np.zeros(len(y))
    for k in range(folds):
        seen = np.flatnonzero(fold != k)
        part = [rows[i] for i in seen]
        ratios = log_count_ratios(part, y[seen])
        w, b = dual_descent(part, y[seen], ratios)
        for i in np.flatnonzero(fold == k):
            margins[i] = (w[rows[i]] @ ratios[rows[i]]) / np.sqrt(max(len(rows[i]), 1)) + b
    slope, shift = sigmoid(margins, y)
    ratios = log_count_ratios(rows, y)
    w, b = dual_descent(rows, y, ratios)
    return Model((w * ratios).astype(np.float32), b, slope, shift)


def is_held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most sample_rows labelled documents that are not held out; a document labelled twice counts as its mean label, rounded up.
    Of repeated rows of a document one counts, that of the least features.

    The sample's feature numbers, not its texts, come to the driver: some 5 KB a row, so sample_rows bounds them.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("k")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = {r.k: r.y for r in known.orderBy(F.md5(F.col("k").cast("string")), "k").limit(sample_rows).collect()}
    sent = docs.sparkSession.sparkContext.broadcast(np.array(sorted(chosen), np.int64))
    schema = pa.schema([("k", pa.int64()), ("f", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = sent.value
        for batch in batches:
            own = batch.filter(pa.array(np.isin(batch.column(0).to_numpy(zero_copy_only=False), ids)))
            keys, packed = own.column(0), []
            for _, found, bounds in features(own.column(1)):
                packed += [found[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            if packed:
                yield pa.RecordBatch.from_arrays([keys, pa.array(packed, pa.binary())], schema=schema)

    picked = docs.select(F.col("doc_id").cast("long").alias("k"), F.col("text").cast("string").alias("t")).where("k is not null")
    got = picked.mapInArrow(frugal(run), "k long, f binary").groupBy("k").agg(F.min("f").alias("f")).toArrow()
    pairs = sorted(zip(got.column("k").to_pylist(), got.column("f").to_pylist()))
    rows = [np.frombuffer(f, "<u4").astype(np.int64) for _, f in pairs]
    order = sorted(range(len(pairs)), key=lambda i: (zlib.crc32(str(pairs[i][0]).encode()), i))
    return fit([rows[i] for i in order], np.array([chosen[pairs[i][0]] for i in order], np.int64))


_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model, *, accept: float = ACCEPT) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs, from the whole text alone.

    Null and empty texts have no features and get the bias's score. Other columns are not read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.scores(batch.column(1)))], schema=_OUT)

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), "doc_id long, score double")
    held = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= accept).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, *, accept: float = ACCEPT) -> DataFrame:
    """The rows of docs (doc_id, text, lang, source, n_chars) that score at least accept."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(batch.column(1)) >= accept))

    kinds = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    own = docs.select(*(F.col(c).cast(k) for c, k in kinds.items()))
    return own.mapInArrow(frugal(run), ", ".join(f"{c} {k}" for c, k in kinds.items()))
