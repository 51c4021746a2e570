"""A quality classifier: random-indexing word vectors, pooled per text, and a small network.

Tokens are runs of letters, digits and non-ASCII characters, and runs of other characters but spaces;
case stays. Every token has a sparse random index vector, fixed by its hash. The vector of a word is
the sum of the index vectors of its neighbours over all documents, which tasks gather in a table of a
fixed number of rows (words share rows by hash); it is scaled to length one. A document is the mean of
its tokens' vectors, the mean of their squares, how alike neighbours at distance one and two are on
average (text that repeats itself is near one), and the logarithm of their number.

A network with one hidden layer is trained by numpy on the driver from at most ``Settings.lessons``
labelled documents, the ones with the smallest hash of their id; a share of them is kept from the
training to calibrate its probabilities by a temperature. Every document is scored in its own row.

Defined cases: a NULL text counts as empty; empty texts have zero means and get the score the network
gives those; documents without a label are scored; with labels of one kind or none the score is that
share, or one half; contradicting labels of one id all count; an empty table gives no rows; other
columns are left as they are. ``lang``, ``source``, ``doc_id`` and labels are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguelake.llm.arrays import summed
from leaguelake.llm.tables import batches_of, tidy
from leaguelake.llm.textbuf import Block, blocks, mix, span_hashes

KEEP_FROM = 0.3  # scores from here on count as good
BATCH_ROWS = 1000  # of documents sent to a worker together


@dataclass(frozen=True)
class Settings:
    rows: int = 1 << 14  # of the table of word vectors
    width: int = 32
    ones: int = 2  # entries of an index vector that are not 0
    reach: int = 2  # neighbours on either side
    lessons: int = 20_000
    hidden: int = 24
    epochs: int = 60
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7

    @property
    def features(self) -> int:
        return 2 * self.width + 3


SPACE, WORD, SIGN = 0, 1, 2
CLASS_OF = np.full(256, SIGN, np.uint8)
CLASS_OF[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS_OF[128:] = WORD
for _a, _b in ("09", "az", "AZ"):
    CLASS_OF[ord(_a) : ord(_b) + 1] = WORD


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of a block, and for each text the range of its tokens."""
    kind = CLASS_OF[block.data]
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[block.offsets] = True
    cuts = np.flatnonzero(edge)
    if len(cuts) < 2:
        return np.zeros(0, np.uint64), np.zeros(len(block) + 1, np.int64)
    real = kind[cuts[:-1]] != SPACE
    starts, ends = cuts[:-1][real], cuts[1:][real]
    return span_hashes(block.data, starts, ends), np.searchsorted(starts, block.offsets)


def _index_vectors(hashes: np.ndarray, s: Settings) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each of the ones of an index vector: its place, and its sign."""
    places, signs = [], []
    for j in range(s.ones):
        bits = mix(hashes + np.uint64(0x9E3779B9 * (j + 1)))
        places.append(((bits >> np.uint64(8)) % np.uint64(s.width)).astype(np.int64))
        signs.append(np.where(bits & np.uint64(1), 1, -1).astype(np.int64))
    return places, signs


def count_neighbours(block: Block, total: np.ndarray, s: Settings) -> None:
    hashes, bounds = tokens(block)
    if not len(hashes):
        return
    row = (hashes % np.uint64(s.rows)).astype(np.int64) * s.width
    owner = np.repeat(np.arange(len(block)), np.diff(bounds))
    places, signs = _index_vectors(hashes, s)
    for step in range(1, s.reach + 1):
        same = owner[step:] == owner[:-step]
        for place, sign in zip(places, signs, strict=True):
            cells = np.concatenate((row[:-step][same] + place[step:][same], row[step:][same] + place[:-step][same]))
            weight = np.concatenate((sign[step:][same], sign[:-step][same]))
            total += np.bincount(cells, weights=weight, minlength=len(total)).astype(np.int64)


def word_vectors(docs: DataFrame, s: Settings) -> np.ndarray:
    """The table of word vectors of all of ``docs``, in which every row has length one or zero."""

    def fill(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for block in blocks(batch.column("text")):
            count_neighbours(block, total, s)

    with batches_of(docs.sparkSession, BATCH_ROWS):
        total = summed(docs.select("text"), fill, s.rows * s.width)
    table = total.reshape(s.rows, s.width).astype(np.float64)
    length = np.sqrt((table * table).sum(1, keepdims=True))
    return (table / np.maximum(length, 1)).astype(np.float32)


def pooled(block: Block, table: np.ndarray, s: Settings) -> np.ndarray:
    """One row of features per text."""
    hashes, bounds = tokens(block)
    row = (hashes % np.uint64(s.rows)).astype(np.int64)
    owner = np.repeat(np.arange(len(block)), np.diff(bounds))
    out = np.zeros((len(block), s.features))
    n = np.diff(bounds)
    step = 1 << 15  # tokens at a time
    for lo in range(0, len(row), step):
        hi = min(lo + step, len(row))
        vectors = table[row[lo:hi]].astype(np.float64)
        first, last = np.searchsorted(bounds, lo, "right") - 1, np.searchsorted(bounds, hi, "left")
        texts = np.arange(first, last)
        texts = texts[n[texts] > 0]
        starts = np.maximum(bounds[texts] - lo, 0)
        out[texts, : s.width] += np.add.reduceat(vectors, starts, axis=0)
        out[texts, s.width : 2 * s.width] += np.add.reduceat(vectors * vectors, starts, axis=0)
        for far in (1, 2):
            later = np.arange(lo, max(lo, min(hi, len(row) - far)))
            later = later[owner[later] == owner[later + far]]
            alike = np.einsum("ij,ij->i", vectors[later - lo], table[row[later + far]])
            out[:, -1 - far] += np.bincount(owner[later], weights=alike, minlength=len(block))
    out[:, :-1] /= np.maximum(n, 1)[:, None]
    out[:, -1] = np.log1p(n)
    return out


@dataclass(frozen=True)
class Network:
    """Two layers; ``mean`` and ``spread`` scale the features, ``temperature`` the output."""

    mean: np.ndarray
    spread: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.mean) / self.spread @ self.inner + self.inner_bias)
        return hidden @ self.outer + self.outer_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(features: np.ndarray, labels: np.ndarray, s: Settings) -> Network:
    """Adam on the logistic loss in small batches, the best epoch on the calibration share wins."""
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(labels))
    held = order[: max(1, len(order) // 5)]
    own = order[len(held) :] if len(order) > 1 else order
    mean, spread = features[own].mean(0), features[own].std(0) + 1e-6
    x, y = (features[own] - mean) / spread, labels[own].astype(float)
    weights = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], s.hidden)),
        np.zeros(s.hidden),
        rng.normal(0, 1 / np.sqrt(s.hidden), s.hidden),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    best, best_loss, t = None, np.inf, 0
    for _ in range(s.epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            t += 1
            hidden = np.tanh(x[part] @ weights[0] + weights[1])
            slope = (_sigmoid(hidden @ weights[2] + weights[3]) - y[part]) / len(part)
            back = slope[:, None] * weights[2] * (1 - hidden * hidden)
            slopes = [x[part].T @ back + s.decay * weights[0], back.sum(0), hidden.T @ slope + s.decay * weights[2], slope.sum(keepdims=True)]
            for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= s.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        network = Network(mean, spread, *(w.copy() for w in weights[:3]), float(weights[3][0]))
        loss = _loss(network.logits(features[held]), labels[held])
        if loss < best_loss:
            best, best_loss = network, loss
    heats = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
    logits = best.logits(features[held])
    heat = min(heats, key=lambda h: _loss(logits / h, labels[held]))
    return Network(best.mean, best.spread, best.inner, best.inner_bias, best.outer, best.outer_bias, float(heat))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id as text is a multiple of five; a NULL id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def _lessons(docs: DataFrame, labels: DataFrame, table, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled documents that are not held out, a bounded number of them."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    chosen = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(s.lessons)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                features = pooled(block, table.value, s)
                rows = pa.array([row.tobytes() for row in features], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("quality").slice(block.lo, len(block)), rows], ["quality", "features"])

    # at most s.lessons ids
    taught = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    # an id may repeat in docs without bound, the lessons may not
    rows = (
        taught.select("quality", "text").mapInArrow(tidy(task), "quality int, features binary")
        .orderBy(F.xxhash64("features"), "features", "quality").limit(2 * s.lessons).collect()
    )
    features = [np.frombuffer(r["features"], np.float64) for r in rows]
    return np.array(features).reshape(len(rows), s.features), np.array([r["quality"] for r in rows])


def with_quality(
    docs: DataFrame, labels: DataFrame, s: Settings = Settings(), name: str = "quality_score"
) -> DataFrame:
    """``docs`` with a column ``name`` between 0 and 1 (higher: label 1 is likelier)."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(word_vectors(docs, s))  # rows * width numbers
    features, known = _lessons(docs, labels, table, s)
    share = float(known.mean()) if len(known) else 0.5
    network = train(features, known, s) if len(known) and 0 < share < 1 else None


    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                network.scores(pooled(block, table.value, s)) if network else np.full(len(block), share)
                for block in blocks(batch.column(text_at))
            ]
            yield batch.append_column(name, pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64()))

    rest = docs.drop(name)
    text_at = rest.columns.index("text")
    return rest.mapInArrow(tidy(task), T.StructType([*rest.schema.fields, T.StructField(name, T.DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    rows = with_quality(docs.select(F.col("doc_id").cast("long"), "text"), labels)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= KEEP_FROM).cast("int").alias("predicted"),
    )
