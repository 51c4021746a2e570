"""WARC archives: writing them, and reading them back by boundary chains.

Writing: Spark's text writer ends every record with two line breaks, which is how WARC ends records,
so archives are ordinary files of plain records on any store Spark can write. Of records with equal
payloads of at least ``least_bytes`` bytes the one with the largest page id is a response and the
others revisit it without a payload.

Reading: the text reader splits archives at the magic that opens a record, wherever the file was cut,
so one large archive is read by many tasks. Each task turns pieces into candidates: their offset
(prefix sums of lengths, per cut and file) and the offset of the successor that their length field
claims. A payload may hold the magic, even a whole record; only candidates on the chain that begins at
offset 0 are records. Pointer jumping finds them in a number of rounds that is the logarithm of the
candidates per file, each round a join of narrow rows that is stored before the next. Payloads are
hashed where they are read; only those that hold the magic are put together again from their pieces.

Defined cases: a NULL html is an empty payload; a NULL page id has no header and sorts lowest; repeated
rows get a record each (of equal rows one is the response); line breaks in an address become spaces;
an empty table gives no rows; other columns are ignored. Payloads are whole. Rows are told apart by
their file and their place in it, and the input is read twice: unless it is ``stable`` (a scan of
Parquet files) it is stored first. Pieces of broken payloads are found again by their content. So no
number depends on how a scan is cut, which changes when executors come or go.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaguelake.scale import AT, FILE, placed, scratch_path, stored

MAGIC = "WARC/1.1\r\n"
BREAK = "\r\n"
END = BREAK + BREAK
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:page-row:"
LEAST_BYTES = 1000


def _row_ids(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.concat_ws("-", F.md5(F.col(FILE).cast("binary")), F.col(AT)).alias("row"),
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha1(html.cast("binary")).alias("digest"),
    )


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK))).otherwise("")


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = LEAST_BYTES,
    date: str = "2000-01-01T00:00:00Z",
    stable: bool = False,
) -> None:
    pages = pages.select("page_id", "url", "html")
    rows = _row_ids(placed(pages if stable else stored(pages, "warc-rows"), "warc-rows"))
    copies = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    firsts = stored(copies.select("digest", "bytes", F.col("first.row").alias("first")), "warc-copies")
    joined = rows.join(firsts, ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("row"))
    payload = F.when(revisit, "").otherwise(F.col("html"))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit(RECORD_ID), F.col("row"), F.lit(">"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]+", " ")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Profile", F.when(revisit, PROFILE)),
        _header("WARC-Refers-To", F.when(revisit, F.concat(F.lit(RECORD_ID), F.col("first"), F.lit(">")))),
        _header("Page-Id", F.col("page_id")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(payload)),
        F.lit(BREAK),
        payload,
    )
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)


def _field(name: str) -> Column:
    """A header's value; the head of a record is its text up to the first empty line."""
    value = F.regexp_extract("head", f"(?:^|\\r\\n){name}: ([^\\r\\n]*)", 1)
    return F.when(value != "", value)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between one magic and the next, with its checksum, the file, the cut it was read in and its
    rank; cut and rank hold within one scan."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("cut"),
            F.monotonically_increasing_id().alias("rank"),
            F.unhex(F.sha1(F.col("value").cast("binary"))).alias("content"),
            "value",
        )
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece with its offset and, where its head is readable, its successor and its fields."""
    empty_line = F.instr("value", END)
    read = pieces(spark, path).select(
        "file",
        "cut",
        "rank",
        "content",
        "value",
        F.octet_length("value").cast("long").alias("length"),
        F.when(empty_line > 0, F.substring_index("value", END, 1)).alias("head"),
    )
    size = F.expr("try_cast(" + "regexp_extract(head, '(?:^|\\\\r\\\\n)Content-Length: ([0-9]+)\\\\r?', 1) as bigint)")
    body = F.expr(f"substring(cast(value as binary), cast(head_bytes + {len(END) + 1} as int), cast(size as int))")
    heads = (
        read.withColumn("size", size)
        .withColumn("head_bytes", F.octet_length("head").cast("long"))
        .withColumn("whole", F.col("head_bytes") + len(END) + F.col("size") <= F.col("length"))
        .select(
            "file",
            "cut",
            "rank",
            "content",
            "length",
            "size",
            "head_bytes",
            "whole",
            _field("WARC-Type").alias("type"),
            _field("WARC-Record-ID").alias("record_id"),
            _field("WARC-Refers-To").alias("refers_to"),
            _field("Page-Id").cast("long").alias("page_id"),
            F.when(F.col("whole"), F.sha1(body)).alias("digest"),
        )
    )
    found = stored(heads, "warc-pieces")
    taken = F.col("length") + len(MAGIC)
    in_cut = Window.partitionBy("file", "cut").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = found.groupBy("file", "cut").agg(F.sum(taken).alias("bytes"))
    before = stored(
        cuts.select("file", "cut", F.coalesce(F.sum("bytes").over(in_file), F.lit(0)).alias("before")), "warc-cuts"
    )
    start = F.coalesce(F.sum(taken).over(in_cut), F.lit(0)) + F.col("before") - len(MAGIC)
    claimed = F.col("offset") + len(MAGIC) + F.col("head_bytes") + len(END) + F.col("size") + len(END)
    # what stands before the first magic of a file is no candidate
    return stored(
        found.join(before, ["file", "cut"])
        .withColumn("offset", start)
        .where("offset >= 0")
        .withColumn("successor", claimed),
        "warc-candidates",
    )


def reachable(found: DataFrame) -> DataFrame:
    """File and offset of the candidates on the chain from each file's start, by pointer jumping.

    After round k the jumps span 4^k records and the reached set holds the first 4^k of each file.
    """
    nodes = found.where("successor IS NOT NULL").select("file", "offset", "successor")
    longest = nodes.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    ends = nodes.select("file", F.col("offset").alias("successor"))
    jumps = stored(nodes.join(ends, ["file", "successor"], "left_semi").select("file", "offset", F.col("successor").alias("to")), "warc-jumps")
    reached = stored(nodes.where("offset = 0").select("file", "offset"), "warc-reached")
    for _ in range(math.ceil(math.log(longest + 1, 4))):
        twice = _compose(jumps)
        near = reached.union(_follow(reached, jumps))
        reached = stored(near.union(_follow(near, twice)).distinct(), "warc-reached")
        jumps = stored(_compose(twice), "warc-jumps")
    return reached


def _follow(places: DataFrame, jumps: DataFrame) -> DataFrame:
    return places.join(jumps, ["file", "offset"]).select("file", F.col("to").alias("offset"))


def _compose(jumps: DataFrame) -> DataFrame:
    second = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("beyond"))
    return jumps.join(second, ["file", "to"]).select("file", "offset", F.col("beyond").alias("to"))


def _put_together(spark: SparkSession, path: str, found: DataFrame, records: DataFrame) -> DataFrame:
    """Digests of the payloads that hold the magic: their pieces joined in order."""
    broken = stored(records.where(~F.col("whole")).select("file", "offset", "successor", "head_bytes", "size"), "warc-broken")
    if broken.isEmpty():
        return broken.select("file", "offset", F.lit(None).cast("string").alias("joined"))
    # the record a piece belongs to is the last one that begins at or before it
    tagged = found.select("file", "offset", "content", "length").join(
        records.select("file", "offset", (~F.col("whole")).alias("starts")), ["file", "offset"], "left"
    )
    so_far = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("starts").isNotNull(), F.struct("offset", "starts")), ignorenulls=True).over(so_far)
    needed = stored(
        tagged.withColumn("owner", owner)
        .where("owner.starts")
        .select("file", "content", "length", F.col("owner.offset").alias("record"), "offset"),
        "warc-needed",
    )
    # equal pieces stand for each other, so one of each is enough
    same = ["content", "length"]
    texts = (
        pieces(spark, path)
        .select("content", F.octet_length("value").cast("long").alias("length"), F.col("value").cast("binary").alias("bytes"))
        .join(needed.select(*same).distinct(), same, "left_semi")
        .dropDuplicates(same)
    )
    whole = (
        texts.join(needed, same)
        .groupBy("file", F.col("record").alias("offset"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("offset").alias("at"), F.col("bytes")))).alias("parts"))
        .withColumn("data", F.expr(f"aggregate(slice(parts, 2, size(parts)), parts[0].bytes, (a, p) -> concat(a, cast('{MAGIC}' as binary), p.bytes))"))
    )
    body = F.expr(f"substring(data, cast(head_bytes + {len(END) + 1} as int), cast(size as int))")
    return whole.join(broken, ["file", "offset"]).select("file", "offset", F.sha1(body).alias("joined"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    found = candidates(spark, path)
    on_chain = stored(found.join(reachable(found), ["file", "offset"], "left_semi"), "warc-records")
    joined = _put_together(spark, path, found, on_chain)
    records = stored(
        on_chain.join(joined, ["file", "offset"], "left").select(
            "page_id", "type", "record_id", "refers_to", "size", F.coalesce("digest", "joined").alias("digest")
        ),
        "warc-read",
    )
    responses = records.where("type = 'response'")
    named = responses.select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("first_page"),
        F.col("size").alias("first_size"),
        F.col("digest").alias("first_digest"),
    )
    revisits = records.where("type = 'revisit'").join(named, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(
        "page_id",
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(
            "page_id", F.col("first_size"), F.col("first_digest"), F.col("type"), F.col("first_page")
        ).toDF(*columns)
    )


def round_trip(pages: DataFrame, stable: bool = False) -> DataFrame:
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, stable=stable)
    return read_archives(spark, path)


ROUND_TRIP_SQL = f"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS t, strlen(t) AS payload_bytes, sha1(t) AS payload_digest FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id < top THEN top END AS refers_to
    FROM g"""
