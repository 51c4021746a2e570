"""Near duplicates by the Jaccard similarity of word shingles: an exact join in tiles.

A text's set are its distinct runs of five words (A-Z lowered). Two texts are linked when their sets'
intersection has at least 75 % of the size of their union. The result is complete; only links whose
ends are already known to be connected are not computed.

1. One pass turns every text into a row: size of the set, a signature of the whole set, four minimum
   hashes, a bitmap of the parity of the hashes, and the sorted hashes (six bytes each).
2. Equal sets are one from here on: copies follow their first row.
3. Rows with an equal minimum hash are compared with the first of them, not with each other. This finds
   most links at the price of a few pairs per row, and families of near copies become components.
4. What that missed is found by prefixes. In one order of all shingles, rare before frequent, linked
   sets share a shingle among their first quarter, and the first one they share is among the first
   seventh of the smaller set. Rows are dealt by these shingles. A short run of
   rows with one shingle gives its pairs of matching size from different components. The rows of long
   runs are first compared exactly within tiles of bounded size, which gives links that span the
   tile and not all pairs; so families whose members are barely alike become components, too. Runs
   that still hold several components are then cut into tiles by size band (bands differ by the largest
   ratio linked sets can have, so a band meets itself and the next) and, within a band, by hash; all
   pairs of tiles are compared as bitmaps, and pairs from different components whose bit counts leave
   room for the overlap go on.
5. All pairs from 3 and 4 pass the bitmap bound, then the sorted arrays are intersected.

Frequent shingles are those that recur among the texts of one Arrow batch; every task counts them over
all its texts (copies once), and the counts are added up in cells whose number follows the input. Most
shingles are in one text only and never counted, so the cells stay sparse; an overestimate only moves
a shingle back, and whatever the counts are, the result is the same. Hot keys: a group of copies is one row before anything is dealt by
shingles; frequent shingles come last, so few runs are long; centres of stars are joined as plain
tables, which adaptive execution splits. Nothing but counters and the largest groups' signatures (a
fixed number, to spare work) is collected.

Defined cases: NULL, empty and blank texts have no shingles and are their own component; one to four
words are one shingle; a NULL id counts in no minimum (a component of NULL ids has a NULL id);
repeated rows are copies of each other; an empty table gives no rows; other columns are left alone.
Shingles are compared by 48 bits of their hash, sets of copies by 128.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.arrays import summed
from leaguelake.llm.graph import components, small
from leaguelake.llm.tables import alone, tidy
from leaguelake.llm.textbuf import LOWER, SPACES, Block, blocks, grams, mix, span_hashes, words
from leaguelake.scale import AT, FILE, placed, stored

WORDS = 5
PERCENT = 75
KEYS = 4
LEAST_CELLS, MOST_CELLS = 1 << 18, 1 << 22
SHINGLES_PER_CELL = 64  # of all shingles, of which few are counted
AT_ONCE = 24 << 20  # bytes of shingles in which recurring ones are looked for
MOST_BITS = 1 << 16
TOP_GROUPS = 100_000
RUN = 64  # rows with one shingle that are paired without tiles
TILE = 512
TILE_BYTES = 16 << 20  # of arrays compared exactly in one tile
PICKS = 3  # long runs a row is compared in before all pairs of tiles are
SET_SCHEMA = "n long, sig_a long, sig_b long, keys array<long>, bits binary, shingles binary"


def shingle_sets(block: Block, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and each text's range."""
    found = words(block, SPACES)
    hashes = span_hashes(block.data, found.starts, found.ends, LOWER)
    keys, first = grams(hashes, found.bounds, width)
    owner = found.owner[first]
    for n in range(1, width):  # short texts: all their words as one
        at = found.bounds[:-1][found.counts == n]
        if len(at):
            whole = np.zeros(len(at), np.uint64)
            for j in range(n):
                whole = mix(whole + hashes[at + j])
            keys = np.concatenate((keys, mix(whole + np.uint64(n))))
            owner = np.concatenate((owner, np.flatnonzero(found.counts == n)))
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[fresh], owner[fresh]
    return keys, np.searchsorted(owner, np.arange(len(block) + 1))


def bit_widths(sizes: np.ndarray) -> np.ndarray:
    """Two to four bits an element: then sets a little too far apart are told by their bitmaps."""
    return 2 ** np.ceil(np.log2(np.clip(2 * sizes, 64, MOST_BITS))).astype(np.int64)


def parity_bits(keys: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set, a bitmap whose bit tells whether an odd number of hashes falls on it."""
    sizes = np.diff(bounds)
    wide = bit_widths(sizes)
    start = np.concatenate(([0], np.cumsum(wide)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = (keys >> np.uint64(16)).astype(np.int64) & (wide[owner] - 1)
    odd = (np.bincount(start[owner] + at, minlength=start[-1]) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]


def folded(bits: bytes, width: int) -> np.ndarray:
    """A parity bitmap of fewer bits, as 64-bit numbers."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, width // 64), axis=0)


def may_overlap(sizes: np.ndarray | int, other: np.ndarray | int, differ: np.ndarray | int):
    """Whether sets of these sizes can be linked if at least ``differ`` elements are in one of them only."""
    most = (sizes + other - differ) // 2
    return (100 + PERCENT) * most >= PERCENT * (sizes + other)


def _pack(keys: np.ndarray) -> np.ndarray:
    """The upper 48 bits of each hash, six bytes each; order is kept."""
    return (keys >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and where each value begins, without copying them."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def unpack(data: bytes | np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n", "sig_a", "sig_b", "keys", "bits", "shingles"]
    for batch in batches:
        own = [c for c in batch.schema.names if c != "text"]
        for block in blocks(batch.column("text")):
            keys, bounds = shingle_sets(block)
            n = np.diff(bounds)
            some = n > 0
            starts = bounds[:-1][some]
            signature = np.zeros((2, len(block)), np.uint64)
            least = np.zeros((len(block), KEYS), np.uint64)
            if some.any():
                for j, salt in enumerate((0x1234567, 0x89ABCDE)):
                    signature[j, some] = np.add.reduceat(mix(keys + np.uint64(salt)), starts)
                for j in range(KEYS):
                    least[some, j] = np.minimum.reduceat(mix(keys ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64)), starts)
            packed = _pack(keys).tobytes()
            lists = pa.ListArray.from_arrays(np.arange(len(block) + 1, dtype=np.int32) * KEYS, pa.array(least.ravel().view(np.int64)))
            ids = [batch.column(c).slice(block.lo, len(block)) for c in own]
            yield pa.RecordBatch.from_arrays(
                [
                    *ids,
                    pa.array(n, pa.int64()),
                    *(pa.array(s.view(np.int64)) for s in signature),
                    lists,
                    pa.array(parity_bits(keys, bounds), pa.binary()),
                    pa.array([packed[6 * a : 6 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary()),
                ],
                [*own, *names],
            )


def sets_of(docs: DataFrame, *more: str) -> DataFrame:
    """Every row numbered, with its shingles and its columns ``more``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), *more, F.col("text").cast("string")
    )
    kept = ", ".join(f"{name} {kind}" for name, kind in rows.drop("text").dtypes)
    return stored(rows.mapInArrow(tidy(_set_rows), f"{kept}, {SET_SCHEMA}"), "shingle-sets")


def _copies(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row with the first row of an equal set, and the groups of more than one."""
    signature = ["n", "sig_a", "sig_b"]
    groups = stored(
        sets.where("n > 0").groupBy(*signature).agg(F.min("row").alias("first"), F.count("*").alias("copies")).where("copies > 1"),
        "shingle-copies",
    )
    rows = sets.select("row", "doc_id", *signature).join(groups, signature, "left")
    members = rows.select("row", "doc_id", "n", F.coalesce("first", "row").alias("first"))
    return stored(members, "shingle-members"), groups


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough: bitmaps first, then the sorted arrays."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "shingle-pairs")
    ids = stored(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(), "shingle-paired")
    sides = sets.join(small(ids), "row", "left_semi")
    bits = stored(sides.select("row", "n", "bits"), "shingle-bits")
    near = stored(_joined(pairs, bits, ["n", "bits"]).mapInArrow(tidy(_bounded), "a long, b long"), "shingle-near")
    ids = stored(near.select(F.col("a").alias("row")).union(near.select("b")).distinct(), "shingle-paired")
    arrays = stored(sets.join(small(ids), "row", "left_semi").select("row", "n", "shingles"), "shingle-arrays")
    return _joined(near, arrays, ["n", "shingles"]).mapInArrow(tidy(_intersected), "a long, b long")


def _joined(pairs: DataFrame, sides: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of both ends of every pair."""

    def side(end: str) -> DataFrame:
        return sides.select(F.col("row").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns])

    return pairs.join(side("a"), "a").join(side("b"), "b")


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = {name: batch.column(name) for name in batch.schema.names}
        sizes, other = column["a_n"].to_numpy(), column["b_n"].to_numpy()
        differ = np.zeros(batch.num_rows, np.int64)
        for i in range(batch.num_rows):
            x, y = column["a_bits"][i].as_py(), column["b_bits"][i].as_py()
            width = min(len(x), len(y)) * 8
            differ[i] = np.bitwise_count(folded(x, width) ^ folded(y, width)).sum()
        keep = pa.array(may_overlap(sizes, other, differ))
        yield pa.RecordBatch.from_arrays([column["a"], column["b"]], ["a", "b"]).filter(keep)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending arrays."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)) if len(y) else 0


def _intersected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = {name: batch.column(name) for name in batch.schema.names}
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            common = overlap(unpack(column["a_shingles"][i].as_py()), unpack(column["b_shingles"][i].as_py()))
            union = column["a_n"][i].as_py() + column["b_n"][i].as_py() - common
            keep[i] = 100 * common >= PERCENT * union
        yield pa.RecordBatch.from_arrays([column["a"], column["b"]], ["a", "b"]).filter(pa.array(keep))


def _star_pairs(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Rows that share a minimum hash, paired with the first of them."""
    firsts = members.where("row = first AND n > 0").select("row")
    keys = stored(
        sets.where("n > 0")
        .select("row", F.posexplode("keys").alias("which", "key"))
        .join(stored(firsts, "shingle-firsts"), "row", "left_semi"),
        "shingle-keys",
    )
    centres = stored(
        keys.groupBy("which", "key").agg(F.min("row").alias("centre"), F.count("*").alias("k")).where("k > 1").drop("k"),
        "shingle-centres",
    )
    return keys.join(centres, ["which", "key"]).where("row <> centre").select(F.col("centre").alias("a"), F.col("row").alias("b"))


def recurring(shingles: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of the sets have, and how many."""
    keys = unpack(np.concatenate(shingles))
    keys.sort()
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    times = np.diff(np.append(start, len(keys)))
    again = times > 1
    return keys[start[again]], times[again]


def shingle_levels(sets: DataFrame) -> np.ndarray:
    """For each cell of shingles, a few bits of the logarithm of how often those of it recur; a power of
    two of cells."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    cells = 1 << int(np.ceil(np.log2(np.clip(total / SHINGLES_PER_CELL, LEAST_CELLS, MOST_CELLS))))

    def fill(batch: pa.RecordBatch, counts: np.ndarray) -> None:
        if not batch.num_rows:
            return
        data, offsets = _binary(batch.column("shingles"))
        _, once = np.unique(batch.column("sig_a").to_numpy(), return_index=True)
        held, size = [], 0
        for i in [*np.sort(once).tolist(), None]:
            if held and (i is None or size + int(offsets[i + 1] - offsets[i]) > AT_ONCE):
                keys, times = recurring(held)
                np.add.at(counts, (keys & np.uint64(cells - 1)).astype(np.int64), times)
                held, size = [], 0
            if i is not None:
                held.append(data[offsets[i] : offsets[i + 1]])
                size += len(held[-1])

    counts = summed(sets.select("sig_a", "shingles"), fill, cells)
    return np.minimum(np.ceil(4 * np.log2(1 + counts)), 255).astype(np.uint8)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Of two linked sets, the first so many elements of either in any common order share one."""
    return n - (PERCENT * n + 99) // 100 + 1


def early_length(n: np.ndarray) -> np.ndarray:
    """The first element that a set shares with a linked set not smaller than itself is among so many:
    their intersection has at least 2 PERCENT / (100 + PERCENT) of the smaller one's size."""
    return n + (-2 * PERCENT * n) // (100 + PERCENT) + 1


def prefix_rows(level, groups):
    """A task from rows (row, comp, n, sig_a, sig_b, shingles) to (token, row, n, comp), without the
    copies in ``groups``; both arguments are broadcast. To travel in fewer bytes, ``comp`` is the
    difference to the row, and n is negative where the token is not an early one of its set."""

    def copies(batch: pa.RecordBatch) -> np.ndarray:
        """Which rows are in one of ``groups`` and not its first one."""
        known = groups.value
        row, n, a, b = (batch.column(c).to_numpy() for c in ("row", "n", "sig_a", "sig_b"))
        if not len(known["sig_a"]):
            return np.zeros(len(row), bool)
        at = np.minimum(np.searchsorted(known["sig_a"], a), len(known["sig_a"]) - 1)
        return (known["sig_a"][at] == a) & (known["sig_b"][at] == b) & (known["n"][at] == n) & (known["first"][at] != row)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.uint64(len(level.value) - 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, comps, sizes = (batch.column(c).to_numpy() for c in ("row", "comp", "n"))
            data, offsets = _binary(batch.column("shingles"))
            own = np.flatnonzero((sizes > 0) & ~copies(batch))
            for lo in range(0, len(own), 256):
                part = own[lo : lo + 256]
                n = (offsets[part + 1] - offsets[part]).astype(np.int64) // 6
                keys = unpack(np.concatenate([data[offsets[i] : offsets[i + 1]] for i in part]))
                owner = np.repeat(np.arange(len(part)), n)
                order = np.lexsort((level.value[(keys & cells).astype(np.int64)], owner))
                begin = np.concatenate(([0], np.cumsum(n)))
                place = np.arange(len(keys)) - begin[owner]
                taken = place < prefix_length(n)[owner]
                whose = owner[taken]
                early = place[taken] < early_length(n)[whose]
                size = sizes[part][whose]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[order][taken].view(np.int64)),
                        pa.array(rows[part][whose]),
                        pa.array(np.where(early, size, -size)),
                        pa.array((comps - rows)[part][whose]),
                    ],
                    ["token", "row", "n", "comp"],
                )

    return tidy(task)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token to pairs (token NULL) of short runs, and the rows of long ones (b NULL).

    Keeps at most the rows of one batch and ``RUN`` more, however long a run is.
    """
    names = ["token", "a", "b", "n", "comp"]
    kinds = [pa.int64()] * 5
    carry = np.zeros((4, 0), np.int64)
    passing = None  # the token of a long run that is being handed on

    def emit(token, a, b, n, comp):
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((token, a, b, n, comp), kinds, strict=True)], names)

    def nulls(n):
        return pa.nulls(n, pa.int64())

    def handle(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole runs."""
        token, row, marked, comp = rows
        n, early = np.abs(marked), marked > 0
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.append(start, len(token)))
        left, right = [], []
        for step in range(1, min(int(size.max()), RUN)):
            i = np.arange(len(token) - step)
            same = i[token[i] == token[i + step]]
            if not len(same):
                break
            other = same + step
            lesser, larger = np.minimum(n[same], n[other]), np.maximum(n[same], n[other])
            fits = (comp[same] != comp[other]) & (100 * lesser >= PERCENT * larger)
            fits &= np.repeat(size, size)[same] <= RUN
            # the first token that two linked sets share is an early one of the smaller set
            fits &= (early[same] | (n[same] > n[other])) & (early[other] | (n[other] > n[same]))
            left.append(row[same[fits]])
            right.append(row[other[fits]])
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            if len(a):
                pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield emit(nulls(pair.shape[1]), pair[0], pair[1], nulls(pair.shape[1]), nulls(pair.shape[1]))
        for i in np.flatnonzero(size > RUN):
            part = slice(start[i], start[i] + size[i])
            if len(np.unique(comp[part])) > 1:
                yield emit(token[part], row[part], nulls(size[i]), n[part], comp[part])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy() for c in ("token", "row", "n", "comp")])
        rows[3] += rows[1]
        if passing is not None:
            more = int(np.searchsorted(rows[0] != passing, True))
            if more:
                yield emit(rows[0, :more], rows[1, :more], nulls(more), np.abs(rows[2, :more]), rows[3, :more])
            rows = rows[:, more:]
            if not rows.shape[1]:
                continue
            passing = None
        rows = np.concatenate((carry, rows), axis=1)
        last = int(np.flatnonzero(rows[0] != rows[0, -1])[-1]) + 1 if rows[0, 0] != rows[0, -1] else 0
        if last:
            yield from handle(rows[:, :last])
        carry = rows[:, last:]
        if carry.shape[1] > RUN:
            yield emit(carry[0], carry[1], nulls(carry.shape[1]), np.abs(carry[2]), carry[3])
            passing, carry = int(carry[0, 0]), carry[:, :0]
    if carry.shape[1]:
        yield from handle(carry)


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of runs that hold more than one component; the others have nothing to add."""
    runs = rows.groupBy("token").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
    return stored(rows.join(stored(runs.select("token"), "shingle-mixed"), "token", "left_semi"), "shingle-long-runs")


def _spanning_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components within tiles of long runs, enough to connect what is linked there."""
    if rows.isEmpty():
        return rows.select(F.col("row").alias("a"), F.col("row").alias("b"))
    size = stored(
        rows.groupBy("token").agg(
            F.count("*").alias("k"),
            F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum(F.col("n") * 6) / TILE_BYTES)).alias("tiles"),
        ),
        "shingle-run-sizes",
    )
    longest = Window.partitionBy("row").orderBy(F.desc("k"), "token")
    picked = stored(
        rows.join(size, "token").withColumn("pick", F.row_number().over(longest)).where(F.col("pick") <= PICKS)
        .select("token", "row", "comp", F.pmod(F.xxhash64("row", "token"), F.col("tiles")).alias("tile")),
        "shingle-picked",
    )
    ids = stored(picked.select("row").distinct(), "shingle-long-rows")
    arrays = stored(sets.join(small(ids), "row", "left_semi").select("row", "n", "bits", "shingles"), "shingle-long-arrays")
    return picked.join(arrays, "row").groupBy("token", "tile").applyInPandas(_connect, "a long, b long")


def _connect(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("row", ignore_index=True)
    width = min(map(len, frame["bits"])) * 8
    bits = np.stack([folded(x, width) for x in frame["bits"]])
    n, comp, row = (frame[c].to_numpy() for c in ("n", "comp", "row"))
    comp = comp.copy()
    arrays = [unpack(x) for x in frame["shingles"]]
    found = []
    for i in range(len(row)):
        fits = (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i]))
        fits[: i + 1] = False
        others = np.flatnonzero(fits)
        differ = np.bitwise_count(bits[others] ^ bits[i]).sum(1).astype(np.int64)
        for j in others[may_overlap(n[others], n[i], differ)].tolist():
            if comp[j] != comp[i]:
                common = overlap(arrays[i], arrays[j])
                if 100 * common >= PERCENT * (n[i] + n[j] - common):
                    found.append((row[i], row[j]))
                    comp[comp == comp[j]] = comp[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _tile_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs from the long runs: tiles of one or two neighbouring size bands, compared as bitmaps."""
    if rows.isEmpty():
        return rows.select(F.col("row").alias("a"), F.col("row").alias("b"))
    ids = stored(rows.select("row").distinct(), "shingle-long-rows")
    bits = stored(sets.join(small(ids), "row", "left_semi").select("row", "bits"), "shingle-long-bits")
    # linked sizes differ by 100 / PERCENT at most; the next band is reached, the one after it is not
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    banded = rows.withColumn("band", band)
    tiles = stored(
        banded.groupBy("token", "band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "shingle-tiles"
    )
    dealt = stored(
        banded.join(tiles, ["token", "band"]).join(bits, "row").withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int")),
        "shingle-dealt",
    )
    own = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "token", F.col("band").alias("low"), F.lit(True).alias("same"),
        F.least("tile", "k").alias("i"), F.greatest("tile", "k").alias("j"),
        (F.col("tile") <= F.col("k")).alias("left"), "row", "n", "comp", "bits",
    )
    following = tiles.select("token", (F.col("band") - 1).alias("band"), F.col("tiles").alias("others"))
    lower = dealt.join(following, ["token", "band"]).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "token", F.col("band").alias("low"), F.lit(False).alias("same"), F.col("tile").alias("i"), F.col("k").alias("j"),
        F.lit(True).alias("left"), "row", "n", "comp", "bits",
    )
    previous = tiles.select("token", (F.col("band") + 1).alias("band"), F.col("tiles").alias("others"))
    upper = dealt.join(previous, ["token", "band"]).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "token", (F.col("band") - 1).alias("low"), F.lit(False).alias("same"), F.col("k").alias("i"), F.col("tile").alias("j"),
        F.lit(False).alias("left"), "row", "n", "comp", "bits",
    )
    together = own.unionByName(lower).unionByName(upper)
    return together.groupBy("token", "low", "same", "i", "j").applyInPandas(_compare_tiles, "a long, b long")


def _compare_tiles(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    diagonal = bool(key[2]) and key[3] == key[4]
    left = frame if diagonal else frame[frame["left"]]
    right = frame if diagonal else frame[~frame["left"]]
    found = []
    if len(left) and len(right):
        width = min(map(len, frame["bits"])) * 8
        bits = np.stack([folded(x, width) for x in right["bits"]])
        n, comp, row = (right[c].to_numpy() for c in ("n", "comp", "row"))
        for x_row, x_n, x_comp, x_bits in zip(left["row"], left["n"], left["comp"], left["bits"], strict=True):
            fits = (comp != x_comp) & (100 * np.minimum(n, x_n) >= PERCENT * np.maximum(n, x_n))
            others = np.flatnonzero(fits & (row > x_row) if diagonal else fits)
            differ = np.bitwise_count(bits[others] ^ folded(x_bits, width)).sum(1).astype(np.int64)
            found += [(x_row, y) for y in row[others[may_overlap(n[others], x_n, differ)]].tolist()]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _with_root(rows: DataFrame, roots: DataFrame, row: str, name: str) -> DataFrame:
    """``rows`` with the component of their column ``row``: its root, or itself."""
    known = small(roots).select(F.col("row").alias(row), F.col("root").alias("__root"))
    return rows.join(known, row, "left").withColumn(name, F.coalesce("__root", row)).drop("__root")


def _missed_links(sets: DataFrame, groups: DataFrame, roots: DataFrame) -> DataFrame:
    """Links among rows of different components that share a shingle of their prefixes."""
    context = sets.sparkSession.sparkContext
    level = context.broadcast(shingle_levels(sets))
    largest = groups.orderBy(F.desc("copies"), "first").limit(TOP_GROUPS).toArrow().sort_by("sig_a")
    firsts = context.broadcast({c: largest.column(c).to_numpy() for c in ("n", "sig_a", "sig_b", "first")})
    heavy = sets.where("n > 0").select("row", "n", "sig_a", "sig_b", "shingles")
    tokens = _with_root(heavy, roots, "row", "comp").mapInArrow(
        prefix_rows(level, firsts), "token long, row long, n long, comp long"
    )
    runs = stored(
        tokens.repartition("token").sortWithinPartitions("token").mapInArrow(tidy(_runs), "token long, a long, b long, n long, comp long"),
        "shingle-runs",
    )
    level.destroy()
    firsts.destroy()
    long = _mixed(runs.where("b IS NULL").select("token", F.col("a").alias("row"), "n", "comp"))
    near = stored(_spanning_links(long, sets), "shingle-links")
    roots = stored(components(near.union(_edges(roots))), "shingle-roots")
    long = _mixed(_with_root(long.drop("comp"), roots, "row", "comp"))
    pairs = runs.where("b IS NOT NULL").select("a", "b").union(_tile_pairs(long, sets))
    apart = _with_root(_with_root(pairs, roots, "a", "x"), roots, "b", "y").where("x <> y").select("a", "b")
    return stored(_linked(apart, sets), "shingle-links").union(_edges(roots))


def _edges(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("row").alias("a"), F.col("root").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``row`` (its number in one scan), doc_id, n_shingles, component_id and root of every row."""
    return alone(docs.sparkSession, "near-duplicates", lambda: _grouped(sets_of(docs)))


def _grouped(sets: DataFrame) -> DataFrame:
    members, groups = _copies(sets)
    links = stored(_linked(_star_pairs(sets, members), sets), "shingle-links")
    stars = components(links)
    # copies that were not dropped belong to the component of their first row
    copies = members.where("row <> first").select("row", "first")
    own = stars.select(F.col("row").alias("first"), "root")
    roots = stored(
        stars.union(copies.join(own, "first", "left").select("row", F.coalesce("root", "first").alias("root"))), "shingle-roots"
    )
    final = stored(components(_missed_links(sets, groups, roots)), "shingle-roots")
    rooted = stored(
        members.join(final, "row", "left").select("row", "doc_id", "n", F.coalesce("root", "row").alias("root")), "shingle-rooted"
    )
    ids = stored(
        rooted.groupBy("root").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("k")).where("k > 1").drop("k"), "shingle-ids"
    )
    return rooted.join(ids, "root", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least_id", "doc_id").alias("component_id"), "root"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one row, that of the smallest id, of each component.

    Rows are found again by their file and their place in it, which do not depend on how a scan is cut;
    ``docs`` is a scan of Parquet files, or is stored first.
    """
    rows = placed(docs, "shingle-docs")

    def others() -> DataFrame:
        sets = sets_of(rows, FILE, AT)
        found = stored(_grouped(sets), "shingle-result")
        first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))
        kept = found.groupBy("root").agg(first.alias("first"), F.count("*").alias("k")).where("k > 1")
        best = stored(kept.select("root", F.col("first.row").alias("best")), "shingle-best")
        others = found.join(best, "root").where("row <> best").select("row")
        return stored(sets.select("row", FILE, AT).join(others, "row").select(FILE, AT), "shingle-dropped")

    dropped = alone(docs.sparkSession, "near-copies", others)
    return rows.join(small(dropped, width=256), [FILE, AT], "left_anti").select(*docs.columns)
