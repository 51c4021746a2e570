"""Language identification: multinomial logistic regression on TF-IDF character n-grams, trained by FTRL.

Text is folded (letters to lower case, every run of other characters to one space, a space at either
end) and read as runs of one, two and three characters. A run is its characters' code points side by
side in one number, so runs are told apart exactly and nothing is hashed into cells. A run's weight in a
text is its share of the text's runs times its inverse document frequency.

The model learns from at most ``Settings.lessons`` labelled texts, the same number for each language as
far as there are so many, chosen by a hash of the row; its features are the runs that at least
``Settings.least`` of those texts have. How frequent these runs are is counted over all texts it may
learn from. Weights are found by follow-the-regularised-leader, one text at a time, with step sizes
per weight, an L1 penalty that leaves most weights zero and an L2 penalty that holds the others down.
A fifth of the lessons is kept from that and gives the temperature that calibrates the probabilities.
Every text is then judged whole, in its own row.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; a text none of whose runs
are known gets what the biases give; a NULL lang teaches nothing; with one language to learn, texts
with a letter get that language with score 1; with none, every text is ``und`` with score 0; a NULL id counts as
empty text in the checksum; repeated rows are judged each; an empty table gives no rows; other
columns are ignored. ``lang``, ``source`` and ``doc_id`` are no inputs of a prediction.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.arrays import summed
from leaguelake.llm.tables import Shelf, tidy
from leaguelake.llm.textbuf import mix

NONE = "und"
SPACE = 32
CHUNK = 1 << 16  # characters judged at a time


@dataclass(frozen=True)
class Settings:
    lessons: int = 6000  # labelled texts, of all languages together
    least: int = 2  # of the lessons must have a run that counts
    scale: float = 50.0  # of the features
    step: float = 0.5
    damping: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    epochs: int = 4
    seed: int = 11


@functools.cache
def folding() -> np.ndarray:
    """For code points below U+10000: the letter in lower case, or a space. Marks stay, as parts of words."""
    out = np.full(1 << 16, SPACE, np.int64)
    for i in range(1 << 16):
        kind = unicodedata.category(chr(i))
        if kind[0] in "LM":
            low = chr(i).lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def folded(text: str) -> np.ndarray:
    """Code points of the folded text, with a space at either end and none after another."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    table = folding()
    plain = np.concatenate(([SPACE], np.where(points < len(table), table[np.minimum(points, len(table) - 1)], points), [SPACE]))
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != SPACE) | (plain[:-1] != SPACE)
    return plain[keep]


def runs(points: np.ndarray) -> np.ndarray:
    """Every run of one to three characters as a number; a space alone is none."""
    one = points[points != SPACE]
    two = points[:-1] | points[1:] << 21
    three = points[:-2] | points[1:-1] << 21 | points[2:] << 42
    return np.concatenate((one, two, three))


def pieces(text: str) -> Iterator[np.ndarray]:
    """The runs of a text, a bounded number at a time: neighbouring parts share two characters."""
    points = folded(text)
    if len(points) <= CHUNK:
        yield runs(points)
        return
    for lo in range(0, len(points), CHUNK):
        part = points[max(lo - 2, 0) : lo + CHUNK]
        found = runs(part)
        if lo:  # what the part before has had already: its last characters, alone and together
            n_one, again = int((part != SPACE).sum()), int((part[:2] != SPACE).sum())
            drop = np.zeros(len(found), bool)
            drop[:again] = True
            drop[n_one] = True
            found = found[~drop]
        yield found


class Lookup:
    """Numbers of known runs: a hash table whose entries are compared with the run itself."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self._bits = max(8, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self._table = np.full(1 << self._bits, -1, np.int64)
        left, probe = np.arange(len(keys)), 0
        self._probes = 0
        while len(left):
            at = self._slot(keys[left], probe)
            free = self._table[at] < 0
            self._table[at[free]] = left[free]  # the last one of equal slots stays
            left = left[self._table[at] != left]
            probe += 1
        self._probes = probe

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        factor, first = mix(np.array([2 * probe + 1, 2 * probe + 2], np.uint64))
        return (keys.view(np.uint64) * (factor | np.uint64(1)) + first >> np.uint64(64 - self._bits)).view(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Their numbers, without those that are unknown."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        out = []
        for probe in range(self._probes):
            entry = self._table[self._slot(wanted, probe)]
            hit = self.keys[entry] == wanted
            hit &= entry >= 0
            out.append(entry[hit])
            wanted = wanted[~hit & (entry >= 0)]  # an empty slot: unknown
            if not len(wanted):
                break
        return np.concatenate(out)


def may_teach(doc_id: Column) -> Column:
    """Whether the checksum of the id as text leaves another remainder by three than one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def _lessons(rows: DataFrame, s: Settings) -> list:
    """(text, lang) of a bounded number of rows, each language with its share, by the hash of the row."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    shelf = Shelf(rows.sparkSession, "languages")
    counts = shelf.put("counts", counts)
    languages = counts.count()
    each = max(1, s.lessons // max(languages, 1))
    # a uniform number per row below the language's rate: so many are expected, and the limit holds in any case
    chance = F.pmod(F.xxhash64("doc_id", "text", "lang"), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.join(counts, "lang").where(chance * F.col("n") < each)
    order = [F.xxhash64(F.lit(s.seed), "doc_id", "text", "lang"), "lang", "text"]
    found = drawn.orderBy(*order).limit(2 * s.lessons).select("text", "lang").collect()
    shelf.clear()
    return found


@dataclass(frozen=True)
class Model:
    languages: list[str]
    keys: np.ndarray  # runs with a weight, ascending
    weights: np.ndarray  # of each run (inverse document frequency and scale included) for each language
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str], lookup: Lookup) -> np.ndarray:
        out = np.tile(self.bias, (len(texts), 1))
        for i, text in enumerate(texts):
            n, total = 0, np.zeros(len(self.bias))
            for part in pieces(text):
                n += len(part)
                total += self.weights[lookup.find(part)].sum(0, dtype=np.float64)
            out[i] += total / max(n, 1)
        return softmax(out / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def shares(text: str, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Known runs of a text and their shares of all of its runs."""
    n, found = 0, []
    for part in pieces(text):
        n += len(part)
        found.append(lookup.find(part))
    at, times = np.unique(np.concatenate(found), return_counts=True)
    return at, times / max(n, 1)


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, features: int, languages: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal; an example is the numbers and values of its features.

    A weight is never stored: it follows from the sum of its slopes and that of their squares, and is
    zero while the former is within the L1 penalty. The bias is the last feature and has no penalty.
    """
    z, n = np.zeros((features + 1, languages)), np.zeros((features + 1, languages))
    l1, l2 = np.full((features + 1, 1), s.l1), np.full((features + 1, 1), s.l2)
    l1[-1], l2[-1] = 0, 0

    def weights(at) -> np.ndarray:
        over = np.maximum(np.abs(z[at]) - l1[at], 0)
        return -np.sign(z[at]) * over / ((s.damping + np.sqrt(n[at])) / s.step + l2[at])

    rng = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in rng.permutation(len(labels)):
            at, value = np.append(examples[i][0], features), np.append(examples[i][1], 1.0)
            w = weights(at)
            slope = softmax(value @ w)
            slope[labels[i]] -= 1
            g = value[:, None] * slope
            squares = n[at]
            grown = squares + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(squares)) / s.step * w
            n[at] = grown
    w = weights(slice(None))
    return w[:-1], w[-1]


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    top = logits.max(1)
    return float(np.mean(np.log(np.exp(logits - top[:, None]).sum(1)) + top - logits[np.arange(len(labels)), labels]))


def document_counts(texts: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of the texts each run occurs, and how many texts there are. All of them count."""
    shared = texts.sparkSession.sparkContext.broadcast(keys)  # runs of the lessons
    lookup: list[Lookup] = []

    def fill(batch: pa.RecordBatch, total: np.ndarray) -> None:
        if not lookup:
            lookup.append(Lookup(shared.value))
        seen = np.zeros(len(shared.value), bool)
        column = batch.column("text")
        for i in range(batch.num_rows):
            seen[:] = False
            for part in pieces(column[i].as_py() or ""):
                seen[lookup[0].find(part)] = True
            total[:-1] += seen
        total[-1] += batch.num_rows

    counts = summed(texts, fill, len(keys) + 1)
    return counts[:-1], int(counts[-1])


def learned(docs: DataFrame, s: Settings = Settings()) -> Model | None:
    """A model from the rows of ``docs`` (doc_id, text, lang) that may teach."""
    rows = docs.where(may_teach(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    lessons = _lessons(rows, s)
    languages = sorted({r["lang"] for r in lessons})
    if not languages:
        return None
    if len(languages) == 1:
        return Model(languages, np.zeros(0, np.int64), np.zeros((0, 1)), np.zeros(1), 1.0)
    distinct = [np.unique(np.concatenate([np.unique(p) for p in pieces(r["text"])])) for r in lessons]
    keys, seen = np.unique(np.concatenate(distinct), return_counts=True)
    keys = keys[seen >= s.least]
    counts, texts = document_counts(rows.select("text"), keys)
    idf = np.log((1 + texts) / (1 + counts)) + 1
    lookup = Lookup(keys)
    examples = []
    for r in lessons:
        at, share = shares(r["text"], lookup)
        examples.append((at, share * idf[at] * s.scale))
    labels = np.searchsorted(languages, [r["lang"] for r in lessons])
    order = np.random.default_rng(s.seed).permutation(len(labels))
    held = order[: len(order) // 5]
    own = order[len(held) :]
    w, bias = train([examples[i] for i in own], labels[own], len(keys), len(languages), s)
    heat = 1.0
    if len(held):
        logits = np.stack([examples[i][1] @ w[examples[i][0]] + bias for i in held])
        heat = min(np.exp(np.linspace(np.log(0.1), np.log(10), 161)), key=lambda h: _loss(logits / h, labels[held]))
    some = (w != 0).any(1)
    return Model(languages, keys[some], (w * idf[:, None] * s.scale)[some].astype(np.float32), bias, float(heat))


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """``lang_pred`` and ``score`` for every text of ``docs`` (its own columns doc_id and held_out stay)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        lookup = Lookup(known.keys) if known else None
        for batch in batches:
            at = np.flatnonzero(batch.column("lettered").to_numpy(zero_copy_only=False)) if known else np.zeros(0, np.int64)
            names, scores = np.full(batch.num_rows, NONE, object), np.zeros(batch.num_rows)
            column = batch.column("text")
            for lo in range(0, len(at), 256):
                part = at[lo : lo + 256]
                p = known.probabilities([column[int(i)].as_py() for i in part], lookup)
                names[part] = np.array(known.languages, object)[p.argmax(1)]
                scores[part] = p.max(1)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn("lettered", lettered).mapInArrow(tidy(task), "doc_id long, held_out boolean, lang_pred string, score double")


def predicted(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The contract's columns."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = learned(rows, s)
    return identified(rows.select("doc_id", (~may_teach(F.col("doc_id"))).alias("held_out"), "text"), model)
