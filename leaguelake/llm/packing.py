"""Packing tokenized documents into sequences of fixed length by exact complements.

Every document becomes token ids and a closing id; only documents longer than a sequence are cut. What
is packed are lengths: how many pieces of each length there are is at most one number per length, and
the plan is made from these numbers alone. Longest first, a length looks for one, two or three lengths
that fill its gap exactly, as often as all of them are available; what is left is packed best fit. A
step uses up at least one length, so plan and time are bounded by the sequence length, not the data.

A piece's place follows from its rank among the pieces of its length: tasks number their own pieces,
and sums per task and length give the offset of each task. No piece meets more than its own row.

Defined cases: a NULL text counts as empty and is the closing id alone; equal rows are packed each; an
empty table gives no rows; other columns are ignored. Texts are tokenized whole; texts within Latin-1
go by words through a bounded memory of words, others through the tokenizer as they are.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.tables import batches_of, tidy
from leaguelake.llm.textbuf import blocks
from leaguelake.scale import stored

LENGTH = 2048
TOKENIZER = "word_bpe_49k.json"
MEMORY = 200_000  # words of which a task keeps the ids, some 50 MB
SEGMENT = 1 << 20  # characters split at a time
BLOCK = 1 << 20  # bytes of texts whose words are looked up together
LOOKED_UP = 8192  # words tokenized as one text
BATCH_ROWS = 1000  # of documents sent to a worker together
CLOSING = (0).to_bytes(4, "little")

# how the tokenizer splits lower-case text, spelled out for characters below U+0100
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_SPACES = "\\t-\\r \\x85\\xa0"
_SPLIT = re.compile(f"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_WORD_END = "</w>"  # how tokens that end a word are spelled
_SPACE = re.compile(f"[{_SPACES}]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Token ids of texts, as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Words that a block of texts needs are looked up together."""
        plain = [self._is_plain(t) for t in texts]
        found = [_SPLIT.findall(t.lower()) if ok and len(t) <= SEGMENT else None for t, ok in zip(texts, plain, strict=True)]
        self._learn(set().union(*(f for f in found if f)))
        out = [f if f is None else b"".join(map(self._known.__getitem__, f)) for f in found]
        for i, text in enumerate(texts):
            if out[i] is None:
                out[i] = self._words(text) if plain[i] else self._whole(text)
        return out

    def _learn(self, needed: set[str]) -> None:
        missing = [w for w in needed if w not in self._known]
        if missing:
            if len(self._known) + len(missing) > MEMORY:
                self._known.clear()
                missing = list(needed)
            for at in range(0, len(missing), LOOKED_UP):
                part = missing[at : at + LOOKED_UP]
                self._known.update(zip(part, self._each(part), strict=True))

    @staticmethod
    def _is_plain(text: str) -> bool:
        if "<|" in text:  # may name a special token
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _each(self, found: list[str]) -> list[bytes]:
        """The ids of each word: all words as one text, whose ids are cut after every end of a word."""
        (coded,) = self._tokenizer.encode_batch_fast([" ".join(found)], add_special_tokens=False)
        ids = np.array(coded.ids, "<u4")
        stops = ((np.flatnonzero(self._ends[ids]) + 1) * 4).tolist()
        if len(stops) != len(found):
            return [self._whole(word) for word in found]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _words(self, text: str) -> bytes:
        out = []
        for segment in _segments(text.lower()):
            found = _SPLIT.findall(segment)
            self._learn(set(found))
            out.append(b"".join(map(self._known.__getitem__, found)))
        return b"".join(out)


def _segments(text: str) -> Iterator[str]:
    """Parts of a text cut at spaces, which no token crosses."""
    at = 0
    while len(text) - at > SEGMENT:
        space = _SPACE.search(text, at + SEGMENT)
        end = space.end() if space else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and checksum of every piece (and its ids), with the task that made
    it and its number among that task's pieces of the length."""
    path = path or tokenizer_path()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "lane", "place"] + ["ids"] * with_ids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(path)
        lane = TaskContext.get().partitionId()
        made = np.zeros(length + 1, np.int64)
        for batch in batches:
            for block in blocks(batch.column("text"), BLOCK):
                ids = batch.column("doc_id").slice(block.lo, len(block)).to_pylist()
                rows = []
                for doc_id, coded in zip(ids, coder.encode([block.text(i) for i in range(len(block))]), strict=True):
                    coded += CLOSING
                    for k, at in enumerate(range(0, len(coded), 4 * length)):
                        part = coded[at : at + 4 * length]
                        n = len(part) // 4
                        rows.append((doc_id, k, k * length, n, zlib.crc32(part), lane, int(made[n]), part)[: len(names)])
                        made[n] += 1
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    whole, small = pa.int64(), pa.int32()
    kinds = [whole, small, whole, whole, whole, small, whole] + [pa.binary()] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, lane int, place long" + ", ids binary" * with_ids
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with batches_of(docs.sparkSession, BATCH_ROWS):
        return stored(rows.mapInArrow(tidy(task), schema), "pack-pieces")


Step = tuple[tuple[int, ...], int]


def plan(counts: np.ndarray, length: int = LENGTH) -> list[Step]:
    """Lengths that share a sequence, and how many such sequences; ``counts[n]`` pieces have length n."""
    left = counts.astype(np.int64).copy()
    steps: list[Step] = []

    def take(pattern: tuple[int, ...]) -> None:
        each = np.bincount(pattern, minlength=len(left))
        used = np.flatnonzero(each)
        times = int((left[used] // each[used]).min())
        left[used] -= times * each[used]
        steps.append((pattern, times))

    for longest in range(length, 0, -1):
        while left[longest]:
            pattern = _exact(left, longest, length)
            if pattern is None:
                break
            take(pattern)
    for longest in range(length, 0, -1):
        while left[longest]:
            take(_best_fit(left, longest, length))
    return steps


def _exact(left: np.ndarray, longest: int, length: int) -> tuple[int, ...] | None:
    """``longest`` with the fewest, and of these the longest, available lengths that fill its gap."""
    gap = length - longest
    if gap == 0:
        return (longest,)
    free = left.copy()
    free[longest] -= 1
    one = free > 0
    one[0] = False
    if one[gap]:
        return (longest, gap)
    pair = _pair(free, one, gap, gap)
    if pair:
        return (longest, *pair)
    # a triple's longest member is at least a third of the gap
    for third in np.flatnonzero(one[: gap + 1])[::-1].tolist():
        if 3 * third < gap:
            break
        rest = free.copy()
        rest[third] -= 1
        pair = _pair(rest, rest > 0, gap - third, third)
        if pair:
            return (longest, third, *pair)
    return None


def _pair(free: np.ndarray, one: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
    """Two available lengths of this sum, the larger as large as can be but at most ``most``."""
    larger = np.arange(-(-total // 2), min(total - 1, most) + 1)
    fits = larger[one[larger] & one[total - larger] & ((2 * larger != total) | (free[larger] > 1))] if len(larger) else larger
    return (int(fits[-1]), int(total - fits[-1])) if len(fits) else None


def _best_fit(left: np.ndarray, longest: int, length: int) -> tuple[int, ...]:
    pattern, gap, free = [longest], length - longest, left.copy()
    free[longest] -= 1
    while gap:
        fits = np.flatnonzero(free[1 : gap + 1])
        if not len(fits):
            break
        n = int(fits[-1]) + 1
        times = min(int(free[n]), gap // n)
        pattern += [n] * times
        free[n] -= times
        gap -= times * n
    return tuple(pattern)


def places(steps: list[Step]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, and for the ranks from there on the first sequence and the offset."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in steps:
        offset = 0
        for n in pattern:
            rows.setdefault(n, []).append((used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for n, r in rows.items()}


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Every piece with sequence_id and offset."""
    made = pieces(docs, path, length, with_ids)
    counts = np.zeros(length + 1, np.int64)
    for row in made.groupBy("length").count().collect():  # a row per length
        counts[row["length"]] = row["count"]
    where = made.sparkSession.sparkContext.broadcast(places(plan(counts, length)))
    earlier = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = made.groupBy("length", "lane").agg(F.count("*").alias("n"))
    before = stored(lanes.select("length", "lane", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "pack-lanes")
    ranked = made.join(before, ["length", "lane"]).withColumn("rank", F.col("before") + F.col("place")).drop("before", "lane", "place")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for one in np.unique(n).tolist():
                mine = n == one
                first, sequences, offsets = where.value[one]
                at = np.searchsorted(first, rank[mine], "right") - 1
                sequence[mine] = sequences[at] + rank[mine] - first[at]
                offset[mine] = offsets[at]
            kept = batch.drop_columns(["rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    columns = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank")
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return ranked.mapInArrow(tidy(task), f"{columns}, sequence_id long, offset long").select(*order)


def sequences(placed: DataFrame) -> DataFrame:
    """The ids of each sequence as one binary of 32-bit numbers, from pieces that carry theirs."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
