"""Quality rules on repetition inside a text, from suffix arrays over its words.

Words are runs of anything but space and \\t to \\r. The suffixes are sorted by prefix doubling, all texts
of a block in one array; the longest common prefixes of neighbours give each suffix its longest
repeat. Repeats of at least ``min_words`` words mark their spans; the union of the spans over the words of
the text, and the longest repeat, are limited.

Defined cases: NULL and empty texts have no words and fail the base rule; repeated rows are judged
alike; an empty table gives no rows; other columns are left as they are. A text is handled whole, in
memory proportional to its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.textbuf import SPACES, Block, blocks, grams, mix, span_hashes, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
CONTINUES = (np.arange(256) & 0xC0) == 0x80  # bytes inside a code point
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


@dataclass(frozen=True)
class Limits:
    """Verdicts: a text is kept while it stays within all of them."""

    least_words: int = 10
    window: int = 5
    window_percent: int = 20  # of the words may lie in repeated windows
    min_words: int = 8  # shorter repeats are how people write
    covered_percent: int = 15  # of the words may lie in repeats of min_words
    longest: int = 100  # words of one repeat


def _covered(spans: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a span."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, spans, 1)
    np.add.at(depth, spans + lengths, -1)
    return np.cumsum(depth[:-1]) > 0


def _duplicated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _repeated_lines(block: Block, inside: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    size = len(block.data)
    breaks = np.flatnonzero(block.data == 10)
    starts = np.union1d(block.offsets[:-1], breaks + 1)
    starts = starts[starts < size]
    owner = np.searchsorted(block.offsets, starts, "right") - 1
    following = np.append(breaks, size)[np.searchsorted(breaks, starts)]
    ends = np.minimum(following, block.offsets[owner + 1])
    some = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    real = some[ends] > some[starts]
    starts, ends, owner = starts[real], ends[real], owner[real]
    keys = span_hashes(block.data, starts, ends) ^ mix(owner.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)
    for i, j in zip(order[:-1][alike := keys[order[1:]] == keys[order[:-1]]], order[1:][alike], strict=True):
        # equal hashes are a reason to compare the bytes
        later[j] = np.array_equal(block.data[starts[i] : ends[i]], block.data[starts[j] : ends[j]])
    return np.bincount(owner[later], minlength=len(block))


def longest_repeats(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every position, how many symbols from there on also stand elsewhere in the same text.

    ``symbols`` must differ between texts. Ranks after k symbols are the place of the first suffix of
    the group; only groups that are not yet single are sorted again.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    end = np.repeat(bounds[1:], np.diff(bounds))
    suffixes = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = symbols[suffixes]
    rank[suffixes] = _group_starts(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    ranks, k = [], 1
    while True:
        ranks.append(rank)
        size = np.bincount(rank, minlength=n)
        places = np.flatnonzero(size[rank[suffixes]] > 1)
        if not len(places):
            break
        active = suffixes[places]
        follow = active + k
        second = np.where(follow < end[active], rank[np.minimum(follow, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[active]))
        active, second = active[order], second[order]
        suffixes[places] = active
        group = rank[active]
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        rank = rank.copy()
        rank[active] = places[_group_starts(fresh)]
        k *= 2
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step, rank = 1 << level, ranks[level]
        fits = (left + step <= end[suffixes[:-1]]) & (right + step <= end[suffixes[1:]])
        same = fits & (rank[np.minimum(left, n - 1)] == rank[np.minimum(right, n - 1)])
        common[same] += step
        left[same] += step
        right[same] += step
    best = np.zeros(n, np.int64)
    best[suffixes[1:]] = common
    best[suffixes[:-1]] = np.maximum(best[suffixes[:-1]], common)
    return best


def _group_starts(first: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def measure(block: Block, limits: Limits) -> dict[str, np.ndarray]:
    found = words(block, SPACES)
    inside = ~SPACES[block.data]
    hashes = span_hashes(block.data, found.starts, found.ends)
    owner, counts = found.owner, found.counts
    texts, total = len(block), len(hashes)

    keys, first = grams(hashes, found.bounds, limits.window)
    twice = first[_duplicated(keys ^ mix(owner[first].astype(np.uint64)))]
    in_windows = _covered(twice, np.full(len(twice), limits.window), total)

    covered, longest = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    if total:
        repeats = longest_repeats(mix(hashes) ^ mix(owner.astype(np.uint64) + np.uint64(1)), found.bounds)
        np.maximum.at(longest, owner, repeats)
        long = np.flatnonzero(repeats >= limits.min_words)
        spans = _covered(long, repeats[long], len(repeats))
        covered += np.bincount(owner[spans], minlength=texts)
    return {
        "n_words": counts,
        "word_chars": block.per_text(inside & ~CONTINUES[block.data]),
        "n_symbols": block.per_text(SYMBOLS[block.data]),
        "n_dup_lines": _repeated_lines(block, inside),
        "n_repeat_words": np.bincount(owner[in_windows], minlength=texts),
        "covered_words": covered,
        "longest_repeat": longest,
    }


def with_repetition(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id`` with the figures, ``base_failed`` and ``kept``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in blocks(batch.column("text")):
                figures = measure(block, limits)
                columns = [pa.array(figures[name], pa.int64()) for name in FIGURES]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.lo, len(block)), *columns], ["doc_id", *FIGURES]
                )

    schema = "doc_id long, " + ", ".join(f"{name} long" for name in FIGURES)
    measured = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)
    n = F.col("n_words")
    failed = (n < limits.least_words) | (F.col("n_repeat_words") * 100 > n * limits.window_percent)
    fair = (F.col("covered_words") * 100 <= n * limits.covered_percent) & (
        F.col("longest_repeat") <= limits.longest
    )
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & fair)
