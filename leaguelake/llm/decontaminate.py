"""Benchmark decontamination: word triples as seeds, then Smith-Waterman alignment.

Words are runs of digits, letters and non-ASCII characters with A-Z lowered, so layout and punctuation
do not matter. The triples of an item that occur in some document are its seeds, counted over all
documents. A seed is rare if it occurs at most ``rare`` times, or is the rarest of the item within a
stretch of four words, so long items have many rare seeds. A document that hits a rare seed, or any two seeds of
an item near each other, is aligned with the item there, word by word, unless the words alone show that
no alignment can reach the bar; edited copies keep most of the score. A pair counts when the best
alignment reaches ``score`` of what the whole item would score. What may be missed by this are copies
that share no triple with the item, or a single one that is frequent and the rarest of no stretch.

Items are taken in blocks of bounded size, each broadcast as a sorted array of seeds and answered by
every whole document, so benchmarks of any size are served, one pass more per block; of a block's
items, as many are looked at together as have some hundred thousand hits. Nothing about the documents
is collected or shuffled but the counts of the seeds; a document is judged in its own row.

Defined cases: NULL texts and items count as empty and match nothing; items of fewer than three words
are one seed of all their words; items and documents may repeat, each row is judged; NULL ids stay;
empty tables give no rows; other columns are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.arrays import summed
from leaguelake.llm.tables import tidy
from leaguelake.llm.textbuf import LOWER, NOT_ALNUM, Block, blocks, grams, mix, span_hashes, words
from leaguelake.scale import stored

WIDTH = 3
BLOCK_CHARS = 16_000_000  # of items at a time
PORTION = 1 << 18  # hits looked at together
STRETCH = 4  # words of which the rarest seed is rare
MATCH, MISS, GAP = 2, -1, -1


@dataclass(frozen=True)
class Settings:
    hits: int = 2  # near each other, if none of them is rare
    rare: int = 64  # occurrences in all documents
    score: float = 0.5  # of the item's own
    least_words: int = 8  # what must be found whole of short items
    least_score: float = 0.9


@dataclass(frozen=True)
class Items:
    """Word hashes of the items of a block; seeds ascending, each with the items it stands for (ascending),
    with its first and last place there, and whether it is rare."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    last: np.ndarray
    rare: np.ndarray

    def entries(self, seeds: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries of items lo to hi begin and end, for each of the seeds."""
        n = len(self.words)
        code = np.repeat(np.arange(len(self.seeds)), np.diff(self.first)) * n + self.item
        return np.searchsorted(code, seeds * n + lo), np.searchsorted(code, seeds * n + hi)


def hashed(block: Block) -> tuple[np.ndarray, np.ndarray]:
    found = words(block, NOT_ALNUM)
    return span_hashes(block.data, found.starts, found.ends, LOWER), found.bounds


def seeds_of(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of WIDTH words."""
    return grams(hashes, bounds, WIDTH)


def _short(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1, np.uint64)
    for h in hashes:
        out = mix(out + h)
    return out


def _item_seeds(item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if 0 < len(item) < WIDTH:
        return _short(item), np.zeros(1, np.int64)
    return seeds_of(item, np.array([0, len(item)]))


def _text_seeds(hashes: np.ndarray, bounds: np.ndarray, widths: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """Triples of every text, and shorter runs where items are that short."""
    keys, first = seeds_of(hashes, bounds)
    for n in sorted(widths):
        at = np.concatenate([np.arange(a, b - n + 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] or [np.zeros(0, int)]).astype(int)
        short = np.zeros(len(at), np.uint64)
        for j in range(n):
            short = mix(short + hashes[at + j])
        keys, first = np.concatenate((keys, short)), np.concatenate((first, at))
    return keys, first


def _find(keys: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are seeds, and which seed each of those is."""
    at = np.minimum(np.searchsorted(seeds, keys), len(seeds) - 1)
    hit = np.flatnonzero(seeds[at] == keys)
    return hit, at[hit]


def prepared(rows: list, docs: DataFrame, s: Settings) -> Items | None:
    """Seeds of the items (item_id, text): their triples that occur in ``docs``."""
    texts = [r["text"] or "" for r in rows]
    item_words: list[np.ndarray] = []
    for block in blocks(pa.array(texts, pa.string())):
        hashes, bounds = hashed(block)
        item_words += [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    found = [_item_seeds(w) for w in item_words]
    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in found)]))
    if not len(every):
        return None
    widths = {len(w) for w in item_words if 0 < len(w) < WIDTH}
    shared = docs.sparkSession.sparkContext.broadcast(every)

    def fill(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for block in blocks(batch.column("text")):
            hashes, bounds = hashed(block)
            keys, first = _text_seeds(hashes, bounds, widths)
            hit, seed = _find(keys, shared.value)
            total += np.bincount(seed, minlength=len(total))

    counts = summed(docs.select("text"), fill, len(every))
    keys, items, places, lasts, rare = [], [], [], [], []
    for i, (own, at) in enumerate(found):
        distinct, place = np.unique(own, return_index=True)
        last = len(own) - 1 - np.unique(own[::-1], return_index=True)[1]
        times = counts[np.searchsorted(every, distinct)]
        there = times > 0
        key, begin, times = distinct[there], at[place[there]], times[there]
        # the first one of each stretch, by number of occurrences
        order = np.lexsort((begin, times, begin // STRETCH))
        rarest = np.zeros(len(key), bool)
        rarest[order[np.unique(begin[order] // STRETCH, return_index=True)[1]]] = True
        keys.append(key)
        items.append(np.full(len(key), i))
        places.append(begin)
        lasts.append(at[last[there]])
        rare.append(rarest | (times <= s.rare))
    key, item = np.concatenate(keys), np.concatenate(items).astype(np.int64)
    place, last, few = np.concatenate(places).astype(np.int64), np.concatenate(lasts).astype(np.int64), np.concatenate(rare).astype(bool)
    if not len(key):
        return None
    order = np.argsort(key, kind="stable")
    seeds, first = np.unique(key[order], return_index=True)
    return Items(
        [r["item_id"] for r in rows], item_words, seeds, np.append(first, len(key)), item[order], place[order], last[order], few[order]
    )


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word arrays, and where in ``text`` it ends (exclusive)."""
    row = np.zeros(len(text) + 1, np.int64)
    step = np.arange(len(text) + 1)
    best, end = 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(text == word, MATCH, MISS)
        fresh = np.maximum(row + GAP, 0)
        fresh[1:] = np.maximum(fresh[1:], diagonal)
        # gaps in the item: the best cell to the left, less its distance
        row = np.maximum(np.maximum.accumulate(fresh - GAP * step) + GAP * step, 0)
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def bar(n: int, s: Settings) -> float:
    """The score a match of an item of n words must reach."""
    return max(s.score * MATCH * n, s.least_score * MATCH * min(n, s.least_words))


def may_reach(text: np.ndarray, item: np.ndarray, least: float) -> bool:
    """Whether an alignment may score ``least``: each word of it gains at most MATCH, if the other side
    has it too, and else costs at least one; of either side a stretch is aligned."""
    for one, other in ((text, np.unique(item)), (item, np.unique(text))):
        at = np.minimum(np.searchsorted(other, one), len(other) - 1)
        level = np.concatenate(([0], np.cumsum(np.where(other[at] == one, MATCH, max(MISS, GAP)))))
        if (level - np.minimum.accumulate(level)).max() < least:
            return False
    return True


def matches(block: Block, items: Items, s: Settings) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, word after the last) of every contaminated pair of a block."""
    hashes, bounds = hashed(block)
    if not len(hashes):
        return []
    widths = {len(w) for w in items.words if 0 < len(w) < WIDTH}
    keys, first = _text_seeds(hashes, bounds, widths)
    hit, seed = _find(keys, items.seeds)
    if not len(hit):
        return []
    times = items.first[seed + 1] - items.first[seed]
    n = len(items.words)
    portions = min(n, max(1, -(-int(times.sum()) // PORTION)))
    if portions == 1:
        return _aligned(hashes, bounds, items, s, first[hit], items.first[seed], items.first[seed + 1])
    found = []
    for k in range(portions):
        begin, end = items.entries(seed, k * n // portions, (k + 1) * n // portions)
        some = end > begin
        if some.any():
            found += _aligned(hashes, bounds, items, s, first[hit][some], begin[some], end[some])
    return found


def _aligned(
    hashes: np.ndarray, bounds: np.ndarray, items: Items, s: Settings, at: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> list[tuple[int, int, float, int, int]]:
    """The matches that hits at words ``at`` lead to; a hit's entries of ``items`` go from ``begin`` to ``end``."""
    times = end - begin
    entry = np.repeat(begin, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    at = np.repeat(at, times)
    # a triple that repeats in the item lets the alignment begin anywhere from ``begin`` to ``latest``
    item, begin, latest, rare = items.item[entry], at - items.last[entry], at - items.place[entry], items.rare[entry]
    owner = np.searchsorted(bounds, at, "right") - 1
    order = np.lexsort((begin, item, owner))
    owner, item, begin, latest, rare = owner[order], item[order], begin[order], latest[order], rare[order]
    lengths = np.array([len(w) for w in items.words])
    # hits whose alignments would begin within an item's length of each other belong together
    cut = np.ones(len(owner), bool)
    cut[1:] = (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])
    apart = np.cumsum(cut) * (len(hashes) + 2 * int(lengths.max()) + 1)
    reach = np.maximum.accumulate(latest + apart)
    cut[1:] |= begin[1:] + apart[1:] - reach[:-1] > lengths[item[1:]]
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(owner))
    # an item has one seed at most at a place, so these are different places
    enough = (ends - starts >= s.hits) | np.logical_or.reduceat(rare, starts)
    starts, ends = starts[enough], ends[enough]
    out: dict[tuple[int, int], tuple[float, int, int]] = {}
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        i, t = int(item[a]), int(owner[a])
        own = items.words[i]
        lo = max(int(bounds[t]), int(begin[a]) - len(own))
        hi = min(int(bounds[t + 1]), int(reach[b - 1] - apart[b - 1]) + 2 * len(own))
        part = hashes[lo:hi]
        if not may_reach(part, own, bar(len(own), s)):
            continue
        score, end = align(part, own)
        if score < bar(len(own), s):
            continue
        _, back = align(part[:end][::-1], own[::-1])
        found = (score / (MATCH * len(own)), lo + end - back - int(bounds[t]), lo + end - int(bounds[t]))
        if found[0] > out.get((t, i), (0.0,))[0]:
            out[t, i] = found
    return [(t, i, *x) for (t, i), x in out.items()]


def _item_blocks(benchmark: DataFrame) -> Iterator[list]:
    """The items, a bounded number of characters at a time; equal ones are dealt by their row number."""
    own = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = stored(own.withColumn("row", F.monotonically_increasing_id()), "benchmark-items")
    size = items.agg(F.sum(F.coalesce(F.char_length("text"), F.lit(0)) + 8)).first()[0] or 0
    parts = -(-size // BLOCK_CHARS)
    for part in range(parts):
        yield items.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).orderBy("item_id", "text").collect()


def contaminated(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, score (0 to 1) and the words from first_word to last_word of every match."""
    spark = docs.sparkSession
    names = ["doc_id", "item_id", "score", "first_word", "last_word"]
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], schema)
    for block_of_items in _item_blocks(benchmark):
        items = prepared(block_of_items, rows, s)
        if items is None:
            continue
        shared = spark.sparkContext.broadcast(items)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in blocks(batch.column("text")):
                    found = matches(block, shared.value, s)
                    ids = batch.column("doc_id").slice(block.lo, len(block)).take(pa.array([m[0] for m in found], pa.int64()))
                    rest = [[shared.value.ids[m[1]] for m in found], [m[2] for m in found], [m[3] for m in found], [m[4] - 1 for m in found]]
                    kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, k) for x, k in zip(rest, kinds, strict=True))], names)

        out = out.unionByName(rows.mapInArrow(tidy(task), schema))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that match no item."""
    spark = docs.sparkSession
    at = docs.columns.index("text")
    out = docs
    for block_of_items in _item_blocks(benchmark):
        items = prepared(block_of_items, docs.select(F.col("text").cast("string")), s)
        if items is None:
            continue
        shared = spark.sparkContext.broadcast(items)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for block in blocks(batch.column(at)):
                    keep[[block.lo + m[0] for m in matches(block, shared.value, s)]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(tidy(task), docs.schema)
    return out
