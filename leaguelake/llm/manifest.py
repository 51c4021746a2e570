"""A Merkle manifest of a dataset by time-forward processing.

Every row is a leaf, the hash of its fields. The leaves of a language, in the order of their ids, are the
lowest level of a tree in which runs of eight nodes have one parent; the trees' tops, ordered by language,
are the leaves of one more tree with the same rule, whose top is the root.

A node's label is the place of the last leaf below it, then its level, so children come before their
parent. A forward sweep meets nodes in the order of labels; each sends its digest to its parent through a
priority queue ordered by label, and a node is hashed when the sweep passes its label, with all that
the queue holds for it. A reversed sweep meets them from the last label to the first; each node takes
the proof suffix its parent sent (what a proof needs from there up to the root) and sends every child
that suffix behind the digests of the child's siblings. What a leaf receives is its proof.

The queue is external: a tree is cut into blocks of 512 leaves (three levels), one sweep each, whose
queue holds a few dozen messages; what leaves a block goes to the block above it through a shuffle
sorted by label. One pass more lifts 512 times as many leaves, and no task, language or level has to
fit anywhere: places come from per-partition counts. Only the number of passes is known to the driver.

Defined cases: NULL fields are ``-``; NULL ids come first and are not tampered with; rows of one id are
ordered by their digest, and equal rows are leaves each; a NULL language is a tree of its own, before the
others; a lone leaf is its tree's top, and a lone top the root; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.tables import Shelf
from leaguelake.llm.textbuf import LOWER
from leaguelake.scale import stored

FAN = 8
HEIGHT = 3  # levels of a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
_LOWER = LOWER.tobytes()
PAST = 1 << 62  # a place beyond every leaf


def field(value: bytes | None) -> bytes:
    return b"-" if value is None else b"%d:%b" % (len(value), value)


def joined_hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Node(NamedTuple):
    level: int
    at: int  # number in its level
    digest: str
    children: list[str]


def label(level: int, at: int) -> tuple[int, int, int]:
    """Place of the last leaf below, then level: children first."""
    return (at + 1) * FAN**level - 1, level, at


def forward(leaves: Iterator[tuple[int, str]], height: int) -> Iterator[Node]:
    """The inner nodes above ascending (place, digest), each once its children have been delivered."""
    queue: list[tuple[tuple[int, int, int], int, str]] = []

    def settled(before: int) -> Iterator[Node]:
        while queue and queue[0][0][0] < before:
            due, children = queue[0][0], []
            while queue and queue[0][0] == due:
                children.append(heappop(queue)[2])
            _, level, at = due
            digest = joined_hash(children)
            if level < height:
                heappush(queue, (label(level + 1, at // FAN), at, digest))
            yield Node(level, at, digest, children)

    for place, digest in leaves:
        yield from settled(place)
        if height:
            heappush(queue, (label(1, place // FAN), place, digest))
    yield from settled(PAST)


class Proof(NamedTuple):
    """What stands left and right of a node, level by level up to the root."""

    sides: tuple[tuple[str, str], ...]

    def text(self) -> str:
        return "".join(left + right for left, right in self.sides)

    def fold(self, digest: str) -> str:
        """The root that follows from a leaf."""
        for left, right in self.sides:
            digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
        return digest

    def packed(self) -> str:
        return ";".join(f"{left}|{right}" for left, right in self.sides)

    @classmethod
    def unpacked(cls, packed: str) -> Proof:
        return cls(tuple(tuple(part.split("|")) for part in packed.split(";")) if packed else ())


def backward(nodes: Iterator[tuple[int, int, list[str], object]], top: Proof) -> Iterator[tuple[object, Proof]]:
    """From descending (level, number, children, leaf) the proof of every leaf; ``top`` is that of the first node."""
    queue: list[tuple[tuple[int, int, int], Proof]] = []
    first = True
    for level, at, children, leaf in nodes:
        own = tuple(-x for x in label(level, at))
        if first:
            suffix, first = top, False
        else:
            due, suffix = heappop(queue)
            if due != own:
                raise ValueError(f"node {own} meets a message for {due}")
        if level:
            for i, _ in enumerate(children):
                sides = "".join(children[:i]), "".join(children[i + 1 :])
                to = tuple(-x for x in label(level - 1, at * FAN + i))
                heappush(queue, (to, Proof((sides, *suffix.sides))))
        else:
            yield leaf, suffix


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, tree (sorts like the language, NULL first), digest, and ``other``, the digest of the tampered row if it differs."""
    rows = docs.select(
        F.col("doc_id").cast("long"),
        *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(FIELDS)],
        F.concat(F.lit("1"), F.coalesce(F.col("lang").cast("string"), F.lit(""))).alias("named"),
    ).withColumn("tree", F.when(F.col("f2").isNull(), F.lit("0")).otherwise(F.col("named")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, others = [], []
            *head, texts = (batch.column(f"f{i}").cast(pa.large_binary()) for i in range(len(FIELDS)))
            for *values, text in zip(*(column.to_pylist() for column in head), texts, strict=True):
                text = text.as_py()
                start = hashlib.sha256(b"".join(map(field, values)))
                whole = start.copy()
                whole.update(field(text))
                digests.append(whole.hexdigest())
                other = None
                if values[0] is not None and text and zlib.crc32(values[0]) % TAMPER_EVERY == 0:
                    changed = text.translate(_LOWER)
                    if changed != text:
                        start.update(field(changed))
                        other = start.hexdigest()
                others.append(other)
            columns = [batch.column("doc_id"), batch.column("tree"), pa.array(digests, pa.string()), pa.array(others, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tree", "digest", "other"])

    return rows.mapInArrow(task, "doc_id long, tree string, digest string, other string")


def placed_in_trees(nodes: DataFrame, shelf: Shelf, order: list[str]) -> DataFrame:
    """``nodes`` with their place in their tree and the tree's size.

    A range shuffle sorts all trees after each other; tasks number the rows of each tree they hold, and
    the counts per task and tree, one row each, give where a task begins.
    """
    names = nodes.columns
    kinds = ", ".join(f"{c} {t}" for c, t in nodes.dtypes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            runs = pc.run_end_encode(batch.column("tree"), run_end_type=pa.int64())
            at, begin = [], 0
            for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if value != tree:
                    tree, n = value, 0
                at.append(pa.array(range(n, n + end - begin), pa.int64()))
                n, begin = n + end - begin, end
            columns = [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.concat_arrays(at or [pa.array([], pa.int64())])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "part", "at"])

    # rows that agree in all of the order are alike; the last number may deal them to several tasks
    split = shelf.put("unplaced", nodes.withColumn("lot", F.monotonically_increasing_id()))
    sort = [F.asc("tree"), *[F.asc_nulls_first(c) for c in order], F.asc("lot")]
    dealt = split.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("lot")
    dealt = shelf.put("numbered", dealt.mapInArrow(number, f"{kinds}, part int, at long"))
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.select(
        "tree", "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    begin = shelf.put("begin", begin)
    return dealt.join(begin, ["tree", "part"]).withColumn("place", F.col("before") + F.col("at")).drop("part", "at", "before")


def block_levels(n: int, height: int = HEIGHT) -> int:
    """Levels of a block in a tree of n leaves: ``height``, or as many as a tree that fits into one needs."""
    if n > FAN**height:
        return height
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


NODES = "tree string, block long, n long, level int, at long, digest string, children string, top boolean"
_NODE_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
_NODE_NAMES = ["tree", "block", "n", "level", "at", "digest", "children", "top"]


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _forward_task(height: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            rows = _rows(batches, ["tree", "block", "n", "place", "digest"])
            for (tree, block, n), own in groupby(rows, key=lambda r: r[:3]):
                levels = block_levels(n, height)
                if levels == 0:
                    yield tree, block, n, 0, 0, next(own)[4], "", True
                    continue
                for node in forward(((r[3], r[4]) for r in own), levels):
                    yield tree, block, n, node.level, node.at, node.digest, "".join(node.children), node.level == levels

        return _batches(made(), _NODE_NAMES, _NODE_TYPES)

    return task


def climbed(leaves: DataFrame, shelf: Shelf, name: str, most: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every pass, and (tree, digest) of the trees' tops. ``leaves`` has tree, n, place and digest;
    the largest tree has ``most`` leaves."""
    passes, tops, size = [], None, FAN**height
    nodes = leaves.select("tree", "n", "place", "digest")
    while True:
        blocks = nodes.withColumn("block", F.expr(f"place div {size}"))
        swept = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        passes.append(shelf.put(f"{name}-{len(passes)}", swept.mapInArrow(_forward_task(height), NODES)))
        found = passes[-1].where("top")
        done = found.where(F.col("n") <= size).select("tree", "digest")
        tops = done if tops is None else tops.union(done)
        if most <= size:
            return passes, tops
        most = -(-most // size)
        up = F.expr(f"(n + {size - 1}) div {size}")
        nodes = found.where(F.col("n") > size).select("tree", up.alias("n"), F.col("block").alias("place"), "digest")


def _backward_task(emit: Callable, names: list[str], types: list[pa.DataType]):
    """A task over the rows of blocks, descending by label behind the block's own proof."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            rows = _rows(batches, _SWEEP)
            for (tree, _), own in groupby(rows, key=lambda r: r[:2]):
                head = next(own)
                if head[6] is None:
                    raise ValueError(f"a block of {tree} has no proof of its top")
                stream = ((r[3], r[4], [r[5][i : i + 64] for i in range(0, len(r[5] or ""), 64)], r) for r in own)
                for leaf, proof in backward(stream, Proof.unpacked(head[6])):
                    yield emit(leaf, proof, head)

        return _batches(made(), names, types, 500)

    return task


_SWEEP = ["tree", "block", "end", "level", "at", "children", "proof", "digest", "other", "doc_id", "subroot", "root"]


def _swept_back(nodes: DataFrame, leaves: DataFrame, proofs: DataFrame, emit: Callable, schema: str, types: list[pa.DataType], height: int) -> DataFrame:
    """``emit`` of every leaf with its proof. ``leaves`` has tree, place, digest (and other, doc_id),
    ``proofs`` tree, block, proof of the block's top, subroot and root."""
    names = [c.split()[0] for c in schema.split(", ")]
    inner = nodes.where("level > 0").select(
        "tree", "block", ((F.col("at") + 1) * F.pow(F.lit(FAN), "level").cast("long") - 1).alias("end"), "level", "at", "children"
    )
    own = leaves.select(
        "tree", F.expr(f"place div {FAN**height}").alias("block"), F.col("place").alias("end"), F.lit(0).alias("level"),
        F.col("place").alias("at"), *[c for c in ("digest", "other", "doc_id") if c in leaves.columns],
    )
    heads = proofs.select("tree", "block", F.lit(PAST).alias("end"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("at"), "proof", "subroot", "root")
    stream = heads.unionByName(inner, allowMissingColumns=True).unionByName(own, allowMissingColumns=True)
    for name in _SWEEP:
        if name not in stream.columns:
            stream = stream.withColumn(name, F.lit(None).cast("long" if name == "doc_id" else "string"))
    by = ["tree", "block", F.desc("end"), F.desc("level")]
    sorted_ = stream.select(*_SWEEP).repartition("tree", "block").sortWithinPartitions(*by)
    return sorted_.mapInArrow(_backward_task(emit, names, types), schema)


PROOFS = "tree string, block long, proof string, subroot string, root string"
_PROOF_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]


def _to_block(leaf: tuple, proof: Proof, head: tuple) -> tuple:
    """A leaf of an upper pass is the top of a block below."""
    return leaf[0], leaf[4], proof.packed(), head[10], head[11]


def _descended(passes: list[DataFrame], proofs: DataFrame, shelf: Shelf, name: str, height: int) -> DataFrame:
    """The proofs of the lowest blocks from those of the trees' tops."""
    for i in range(len(passes) - 1, 0, -1):
        below = passes[i - 1].where("top")
        leaves = below.where(F.col("n") > FAN**height).select("tree", F.col("block").alias("place"), "digest")
        # trees whose top lies in a pass below have no block here
        here = passes[i].where("top").select("tree").distinct()
        mine = proofs.join(here, "tree", "left_semi")
        lower = _swept_back(passes[i], leaves, mine, _to_block, PROOFS, _PROOF_TYPES, height)
        lower = shelf.put(f"{name}-proofs-{i}", lower)
        proofs = lower.unionByName(proofs.join(here, "tree", "left_anti"))
    return proofs


def _result(leaf: tuple, proof: Proof, head: tuple) -> tuple:
    digest, other, doc_id = leaf[7], leaf[8], leaf[9]
    folded = proof.fold(digest if other is None else other)
    text = hashlib.sha256(proof.text().encode()).hexdigest()
    return doc_id, digest, head[10], head[11], text, folded, folded == head[11], proof.packed()


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof string"
_RESULT_TYPES = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.string()]


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every row's leaf, its tree's top, the root, what verifying the tampered rows gives, and the
    proof itself (levels divided by ``;``, in each what stands left and right of the node)."""
    spark = docs.sparkSession
    shelf = Shelf(spark, "manifest")
    leaves = shelf.put("leaves", placed_in_trees(leaves_of(docs), shelf, ["doc_id", "digest"]))
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        shelf.clear()
        return spark.createDataFrame([], RESULT)
    passes, tops = climbed(leaves, shelf, "nodes", most, height)
    named = tops.select(F.lit("all").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = shelf.put("upper", placed_in_trees(named, shelf, ["name"]))
    upper_passes, root = climbed(upper, shelf, "upper-nodes", upper.agg(F.max("n")).first()[0], height)
    root = root.first()["digest"]
    start = spark.createDataFrame([("all", 0, "", "", root)], PROOFS)
    over = _descended(upper_passes, start, shelf, "upper", height)

    def of_tree(leaf: tuple, proof: Proof, head: tuple) -> tuple:
        return leaf[8], 0, proof.packed(), leaf[7], head[11]

    named = upper.select("tree", "place", "digest", F.col("name").alias("other"))
    trees = shelf.put("tops", _swept_back(upper_passes[0], named, over, of_tree, PROOFS, _PROOF_TYPES, height))
    proofs = _descended(passes, trees, shelf, "trees", height)
    result = stored(_swept_back(passes[0], leaves, proofs, _result, RESULT, _RESULT_TYPES, height), "manifest-result")
    shelf.clear()
    return result


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return manifest(docs).drop("proof")


def manifest_sql(levels: int = 7, tree_levels: int = 4) -> str:
    """The same for DuckDB, for trees of at most ``levels`` levels."""
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)), "
        "lambda c, ch: list_reduce([xor(c, ch), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"
    )

    def text(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR) END"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    head = " || ".join(text(c) for c in FIELDS[:-1])
    parts = [
        f"""leaves AS MATERIALIZED (
  SELECT doc_id, lang, sha256({head} || {text("text")}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc} % {TAMPER_EVERY} = 0
      THEN sha256({head} || {text(f"translate(text, '{upper}', '{lower}')")})
      ELSE sha256({head} || {text("text")}) END AS changed
  FROM documents)""",
        """d0 AS MATERIALIZED (
  SELECT coalesce('1' || lang, '0') AS k, doc_id, leaf AS digest, changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves)""",
    ]

    def tree(name: str, depth: int) -> None:
        """Levels name0 ... of nodes, and their neighbours in names0 ..."""
        for i in range(depth):
            parts.append(
                f"""{name}s{i} AS MATERIALIZED (
  SELECT k, p, n,
    CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(digest, '') OVER (PARTITION BY k, p // {FAN} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
    CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(digest, '') OVER (PARTITION BY k, p // {FAN} ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
  FROM {name}{i})"""
            )
            parts.append(
                f"""{name}{i + 1} AS MATERIALIZED (
  SELECT k, p // {FAN} AS p, (n + {FAN - 1}) // {FAN} AS n,
    CASE WHEN n = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY p)) END AS digest
  FROM {name}{i} GROUP BY k, p // {FAN}, n)"""
            )

    tree("d", levels)
    parts.append(
        f"""t0 AS MATERIALIZED (
  SELECT 'all' AS k, k AS name, digest, row_number() OVER (ORDER BY encode(k)) - 1 AS p, count(*) OVER () AS n FROM d{levels})"""
    )
    tree("t", tree_levels)
    parts.append(
        f"""f0 AS MATERIALIZED (
  SELECT d0.doc_id, d0.k, d0.p, d0.digest AS leaf, d0.changed AS folded, '' AS proof, t0.digest AS subroot, t0.p AS tp, top.digest AS root
  FROM d0 JOIN t0 ON t0.name = d0.k, t{tree_levels} top)"""
    )
    for i in range(levels + tree_levels):
        side, own = (f"ds{i}", f"o.k = s.k AND o.p // {FAN**i} = s.p") if i < levels else (f"ts{i - levels}", f"o.tp // {FAN ** (i - levels)} = s.p")
        parts.append(
            f"""f{i + 1} AS MATERIALIZED (
  SELECT o.* REPLACE (o.proof || s.l || s.r AS proof, CASE WHEN s.n = 1 THEN o.folded ELSE sha256(s.l || o.folded || s.r) END AS folded)
  FROM f{i} o JOIN {side} s ON {own})"""
        )
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM f{levels + tree_levels}"""
