"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every token type (hashed to ``TYPES`` rows) has a fixed sparse ternary index vector.  One pass over all
documents adds, for each token, the index vectors of its neighbours within ``REACH`` tokens; the summed
table (a fixed size, whatever the corpus) holds the word vectors.  A second pass pools each document's
word vectors: their mean, their spread and the change from token to token, and the logarithm of the
token count.  A two-layer network is trained in numpy on at most ``SAMPLE`` labelled rows (a
documented bound, chosen by hash) and its logits are divided by a temperature fitted on a held-back
part, so that the score is a calibrated probability of label 1.

Tokens are words in lower case, runs of symbols, and marks for words in capitals and with digits.

Defined cases: null and empty texts pool to zeros and get the network's score for that; rows without
usable labels are not learned from; with no label or one class only, the score is that class's share
(0.5 without labels); repeated label rows count as given; repeated documents get equal scores; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import WordMemo, prepare, stored, sum_blocks

TYPES = 1 << 14
DIM = 32
NONZERO = 2
REACH = 2
BLOCK = 1 << 13
SAMPLE = 20_000
HIDDEN = 32
CUT = 0.3
FEATURES = 3 * DIM + 2
_CAPITAL, _NUMBER = 1, 2                       # token types with a meaning of their own; 0 is none


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of every type's index vector."""
    rng = np.random.default_rng(seed)
    place = np.argsort(rng.random((TYPES, DIM)), axis=1)[:, :NONZERO]
    return place.astype(np.int64), rng.choice([-1, 1], (TYPES, NONZERO)).astype(np.int64)


def token_types(words: list[bytes]) -> np.ndarray:
    """Up to three token types of every blank-separated word (0: none)."""
    out = np.zeros((len(words), 3), np.int32)
    for i, w in enumerate(words):
        bare = w.rstrip(b".,;:")
        if bare.isalpha():                             # ASCII letters: the common case
            out[i, 0] = 3 + crc32(bare.lower()) % (TYPES - 3)
            if len(bare) > 1 and bare.isupper():
                out[i, 1] = _CAPITAL
            continue
        s = w.decode("utf-8", "replace")
        core = "".join(filter(str.isalnum, s))
        marks = "".join(c for c in s if not c.isalnum()).strip(".,;:")
        k = 0
        if core:
            number = core.isdigit()
            out[i, k] = _NUMBER if number else 3 + crc32(core.lower().encode()) % (TYPES - 3)
            k += 1
            if not number and len(core) > 1 and core.isupper():
                out[i, k] = _CAPITAL
                k += 1
        if marks:
            out[i, k] = 3 + crc32(b"\0" + marks.encode("utf-8", "replace")) % (TYPES - 3)
    return out


def _tokens(memo: WordMemo, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Flat token types and the bounds of the texts."""
    split = [(t or b"").split() for t in texts]
    words = [w for s in split for w in s]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)
    if not words:
        return np.zeros(0, np.int64), bounds * 0
    rows = memo.rows_of(words)
    some = rows > 0
    upto = np.concatenate([[0], np.cumsum(some.sum(axis=1))])
    return rows[some].astype(np.int64), upto[bounds]


# ---------------------------------------------------------------- word vectors

def _co_occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordMemo(token_types)
    place, sign = index_vectors()
    table = np.zeros(TYPES * DIM, np.int64)
    some = False
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            flat, bounds = _tokens(memo, whole.slice(at, 2000).column(0).cast(pa.binary()).to_pylist())
            doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            some = some or len(flat) > 0
            for d in range(1, REACH + 1):
                if len(flat) <= d:
                    break
                same = doc[d:] == doc[:-d]
                a, b = flat[:-d][same], flat[d:][same]
                for x, y in ((a, b), (b, a)):              # y's index vector goes to x's row
                    base = x * DIM
                    for k in range(NONZERO):
                        cell = base + place[y, k]
                        table += np.bincount(cell, sign[y, k], TYPES * DIM).astype(np.int64)
    if some:
        parts = table.reshape(-1, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(["ri"] * len(parts)), pa.array(np.arange(len(parts), dtype=np.int32)),
             pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], names=["name", "block", "counts"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors [TYPES, DIM] from the neighbours of every token of every document."""
    parts = docs.select("text").mapInArrow(_co_occur, "name string, block int, counts binary")
    table = np.zeros(TYPES * DIM)
    for r in sum_blocks(parts).collect():                      # TYPES x DIM counts
        table[r["block"] * BLOCK: (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
    table = table.reshape(TYPES, DIM)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norm > 0, norm, 1)).astype(np.float32)


def _pool(vectors: np.ndarray):
    memo = WordMemo(token_types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 100):           # small enough for the processor's caches
                b = whole.slice(at, 100)
                flat, bounds = _tokens(memo, b.column(b.num_columns - 1).cast(pa.binary()).to_pylist())
                n = b.num_rows
                size = np.diff(bounds)
                out = np.zeros((n, FEATURES), np.float32)
                v = vectors.take(flat, axis=0)
                ones = np.ones(int(size.max(initial=0)), np.float32)
                for i in np.flatnonzero(size > 0):
                    a, m = bounds[i], size[i]
                    w = v[a: a + m]
                    mean = ones[:m] @ w / m
                    out[i, :DIM] = mean
                    out[i, DIM:2 * DIM] = np.sqrt(np.maximum(np.einsum("ij,ij->j", w, w) / m - mean * mean, 0))
                    if m > 1:
                        out[i, 2 * DIM:3 * DIM] = ones[:m - 1] @ np.abs(w[1:] - w[:-1]) / (m - 1)
                        out[i, -2] = np.count_nonzero(flat[a + 1: a + m] == flat[a: a + m - 1]) / (m - 1)
                out[:, -1] = np.log1p(size)
                values = pa.FixedSizeListArray.from_arrays(pa.array(out.reshape(-1)), FEATURES).cast(
                    pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], values], names=[*b.schema.names[:-1], "pooled"])

    return run


# ---------------------------------------------------------------- network

class Network:
    """Two layers and a temperature; ``score`` gives calibrated probabilities."""

    def __init__(self, constant: float | None = None):
        self.constant = constant

    def fit(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, rounds: int = 400, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        held = rng.random(len(y)) < 0.2
        if held.all() or not held.any() or len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
            held = np.zeros(len(y), bool)
        xt, yt = x[~held], y[~held].astype(float)
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
        best, kept = np.inf, [q.copy() for q in p]
        step = 0
        for epoch in range(max(20, rounds * 256 // max(len(yt), 256) * 2)):
            order = rng.permutation(len(yt))
            for lo in range(0, len(yt), 256):
                i = order[lo: lo + 256]
                h = np.tanh(xt[i] @ p[0] + p[1])
                g = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - yt[i]) / len(i)
                back = np.outer(g, p[2]) * (1 - h * h)
                grads = [xt[i].T @ back + 1e-3 * p[0], back.sum(axis=0), h.T @ g + 1e-3 * p[2], np.array([g.sum()])]
                step += 1
                for k in range(4):
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                    p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
            if held.any():
                loss = self._loss(self._logit(x[held], p), y[held], 1.0)
                if loss < best:
                    best, kept = loss, [q.copy() for q in p]
        self.p = kept if held.any() else p
        self.temperature = 1.0
        if held.any():
            z = self._logit(x[held], self.p)
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
            self.temperature = float(min(grid, key=lambda t: self._loss(z, y[held], t)))
        return self

    @staticmethod
    def _logit(x: np.ndarray, p: list[np.ndarray]) -> np.ndarray:
        return np.tanh(x @ p[0] + p[1]) @ p[2] + p[3]

    @staticmethod
    def _loss(z: np.ndarray, y: np.ndarray, t: float) -> float:
        return float(np.mean(np.logaddexp(0, z / t) - y * z / t))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self._logit((x - self.mean) / self.scale, self.p) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _score(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            s = np.round(net.score(flat.reshape(-1, FEATURES).astype(float)), 9)   # whatever the batch
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                names=[*b.schema.names[:-1], "score", "predicted"])

    return run


def train(pooled: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """A network for ``pooled(doc_id, pooled)`` rows with ``labels(doc_id, quality)``; at most ``sample``
    labelled rows, taken by a hash of the row (a labelled doc_id may stand for any number of rows; rows equal in
    doc_id and vector count once)."""
    marks = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").alias("__id"), (F.col("quality") > 0).cast("int").alias("y"))
    marked = stored(pooled.join(marks, F.col("doc_id") == F.col("__id")).select("pooled", "y", "doc_id").distinct(), "quality-marked")
    n = marked.count()
    if n > sample:                                     # about 0.95 x sample rows: the driver gets no more
        order = F.pmod(F.xxhash64("doc_id", "pooled", "y"), F.lit(1 << 40))
        marked = marked.where(order < int((1 << 40) * 0.95 * sample / n)).limit(sample)
    rows = marked.toPandas()
    rows["v"] = [tuple(v) for v in rows["pooled"]]
    rows = rows.sort_values(["doc_id", "y", "v"])
    y = rows["y"].to_numpy(dtype=float)
    if len(np.unique(y)) < 2:
        return Network(float(y.mean()) if len(y) else 0.5)
    return Network().fit(np.stack([np.asarray(v, float) for v in rows["pooled"]]), y)


def quality_scores(docs: DataFrame, labels: DataFrame, keep: list[Column | str], learn_from: Column,
                   sample: int = SAMPLE) -> DataFrame:
    """``keep`` columns plus score and predicted; labels are learned from rows where ``learn_from``."""
    prepare(docs.sparkSession)
    vectors = word_vectors(docs)
    part = docs.select(F.col("doc_id").alias("__doc"), learn_from.alias("__learn"), *keep, F.col("text").alias("__text"))
    schema = part.drop("__text").schema.add("pooled", T.ArrayType(T.FloatType()))
    pooled = stored(part.mapInArrow(_pool(vectors), schema), "quality-pooled")
    net = train(pooled.where("__learn").select(F.col("__doc").alias("doc_id"), "pooled"), labels, sample)
    rows = pooled.drop("__doc", "__learn")
    return rows.mapInArrow(_score(net), rows.drop("pooled").schema.add("score", "double").add("predicted", "integer"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return quality_scores(docs, labels, [F.col("doc_id"), held.alias("held_out")], ~held)
