"""Secrets in texts, and multipart credentials linked within scopes. Native.

Patterns find parts: assignments, access identifiers, hexadecimal runs (the base, always reported),
and weak ones: names of accounts, short or opaque values, endpoints. A part's scope reaches
from ``SCOPE`` code points before its start to as many after its end, however long it is. An interval join
of the parts with the scopes of their own text says which roles stand in each: of the parts that begin
no later, the one that ends last decides, and of those that begin no earlier, the one that begins first,
which are two running windows over sorted starts. Weak parts are reported only beside what completes them: a secret beside an identifier, an identifier beside a
secret, an endpoint beside both.

Regular expressions run once over every text, in the scan; from there on only lengths travel, so the
shuffles hold a few numbers per part. The key is the row, so no text, id or source gathers more than
its own parts in a task.

Defined cases: NULL counts as the empty text; a text without parts has counts 0, the checksum of the
empty string and empty spans; rows repeat as often as in the input; an empty table gives no rows;
other columns are not carried by ``scan`` and are left alone by ``redact``. Texts are read whole.
Rows are numbered once and stored with their number before anything is joined by it.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.scale import stored

SCOPE = 200
MASK = "[REDACTED]"


def _either_case(words: str) -> str:
    """ASCII letters in either case, spelled out: engines differ in what they fold beyond ASCII."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in words)


_SET = """["']?\\x20*[:=]\\x20*["']?"""
_SECRET_NAMES = _either_case("password|passwd|secret|token|api_?key")
_ACCOUNT_NAMES = _either_case("client_?id|access_?key_?id|user_?name|user|login|account")
_HOST_NAMES = _either_case("endpoint|hostname|host|server")


@dataclass(frozen=True)
class Part:
    """``pattern`` finds it; ``group`` must have ``least`` to ``most`` characters. Whenever a match that
    counts exists, the lowered text contains one of ``hints`` (if there are any) and ``test`` holds;
    they spare most texts the search."""

    kind: str
    role: str
    pattern: str
    group: int
    least: int
    most: int
    base: bool
    test: str
    hints: tuple[str, ...] = ()


LONG = 1 << 30
_ASSIGN = f"({_SECRET_NAMES}){_SET}([A-Za-z0-9+/_.=-]+)"
_SECRET_HINTS = ("passw", "secret", "token", "api")
_ACCOUNT_HINTS = ("client", "access", "user", "login", "account")
_HOST_HINTS = ("endpoint", "host", "server")
PARTS = (
    Part("assign", "secret", _ASSIGN, 2, 12, LONG, True, f"({_SECRET_NAMES}){_SET}[A-Za-z0-9+/_.=-]{{12}}", _SECRET_HINTS),
    # a match of AKIA[A-Z0-9]+ or [0-9a-f]+ ends with its run, so asking for the length finds the same
    Part("access", "identifier", "AKIA[A-Z0-9]{14,}", 0, 18, LONG, True, "AKIA[A-Z0-9]{14}", ("akia",)),
    Part("hex", "secret", "[0-9a-f]{16,}", 0, 16, LONG, True, "[0-9a-f]{16}"),
    Part("weak", "secret", _ASSIGN, 2, 6, 11, False, f"({_SECRET_NAMES}){_SET}[A-Za-z0-9+/_.=-]{{6}}", _SECRET_HINTS),
    Part("opaque", "secret", "[A-Za-z0-9+/]{32,}", 0, 32, LONG, False, "[A-Za-z0-9+/]{32}"),
    Part("account", "identifier", f"({_ACCOUNT_NAMES}){_SET}([A-Za-z0-9_.@-]+)", 2, 3, LONG, False, f"({_ACCOUNT_NAMES}){_SET}[A-Za-z0-9_.@-]{{3}}", _ACCOUNT_HINTS),
    Part("address", "endpoint", "[a-z][a-z0-9+]*://[^\\x00-\\x20\"'<>]+", 0, 8, LONG, False, "[a-z0-9+]://[^\\x00-\\x20\"'<>]", ("://",)),
    Part("host", "endpoint", f"({_HOST_NAMES}){_SET}([A-Za-z0-9.:-]+)", 2, 3, LONG, False, f"({_HOST_NAMES}){_SET}[A-Za-z0-9.:-]{{3}}", _HOST_HINTS),
)
# every weak part is reported beside an identifier only, or is one: without any, none is sought
_IDENTIFIER_HINTS = ("akia", *_ACCOUNT_HINTS)
ROLES = ("identifier", "secret", "endpoint")
NEEDS = {"secret": ("identifier",), "identifier": ("secret",), "endpoint": ("identifier", "secret")}
BASE_KINDS = [p.kind for p in PARTS if p.base]
ROW, KIND, START, END = "__row", "__kind", "__start", "__end"


def _matches(text: Column, number: int, part: Part) -> Column:
    """Of every match: characters since the match before, its length, and its group's length."""
    pattern = F.lit(part.pattern)
    gaps = F.transform(F.split(text, part.pattern, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    group = F.transform(F.regexp_extract_all(text, pattern, F.lit(part.group)), F.char_length)
    zipped = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), whole.alias("length"), group.alias("value")
    )
    found = F.transform(
        zipped,
        lambda m, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("i"),
            m["gap"].alias("gap"),
            m["length"].alias("length"),
            m["value"].alias("value"),
        ),
    )
    return F.when(_sought(text, part), found)


def _holds_any(text: Column, hints: tuple[str, ...]) -> Column:
    lowered = F.lower(text)
    return functools.reduce(operator.or_, [F.contains(lowered, F.lit(h)) for h in hints])


def _sought(text: Column, part: Part) -> Column:
    """Whether the text has to be searched for the part: cheap tests first."""
    tests = [_holds_any(text, part.hints)] if part.hints else []
    tests += [] if part.base else [_holds_any(text, _IDENTIFIER_HINTS)]
    return functools.reduce(operator.and_, [*tests, text.rlike(part.test)])


def _all_matches(text: Column) -> Column:
    kinds = [_matches(text, i, part) for i, part in enumerate(PARTS)]
    none = F.expr("cast(array() as array<struct<kind:int,i:int,gap:int,length:int,value:int>>)")
    return F.concat(*[F.coalesce(k, none) for k in kinds])


def parts(hits: DataFrame) -> DataFrame:
    """Row, kind (its number), start and end of every part to report, from rows with their matches.

    One shuffle by row serves the running positions, the scopes and what is grouped by row after.
    """
    one = hits.where(F.size("hits") > 0).select(ROW, F.explode("hits").alias("m")).select(ROW, "m.*")
    order = Window.partitionBy(ROW, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    lengths = [(F.col("kind") == i) & F.col("value").between(p.least, p.most) for i, p in enumerate(PARTS)]
    counted = lengths[0]
    for one_kind in lengths[1:]:
        counted = counted | one_kind
    placed = (
        one.repartition(ROW)
        .withColumn(END, end)
        .where(counted)
        .select(ROW, F.col("kind").alias(KIND), (F.col(END) - F.col("length")).alias(START), END)
    )
    earlier = Window.partitionBy(ROW).orderBy(START).rangeBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(ROW).orderBy(F.desc(START)).rangeBetween(Window.unboundedPreceding, 0)
    near = {}
    for role in ROLES:
        own = F.col(KIND).isin([i for i, p in enumerate(PARTS) if p.role == role])
        before = F.max(F.when(own, F.col(END))).over(earlier) >= F.col(START) - SCOPE
        after = F.min(F.when(own, F.col(START))).over(later) <= F.col(END) + SCOPE
        near[role] = F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))
    reported = F.col(KIND).isin([i for i, p in enumerate(PARTS) if p.base])
    marked = placed.select("*", *[value.alias(role) for role, value in near.items()])
    for i, part in enumerate(PARTS):
        if not part.base:
            beside = F.lit(True)
            for role in NEEDS[part.role]:
                beside = beside & F.col(role)
            reported = reported | ((F.col(KIND) == i) & beside)
    return marked.where(reported).select(ROW, KIND, START, END)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(p.kind) for p in PARTS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s[KIND]), s[START].cast("string"), s[END].cast("string"))
        ),
        ",",
    )


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, base counts and checksum, and all spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hits = stored(
        _numbered(docs).select(ROW, F.col("doc_id").cast("long"), _all_matches(text).alias("hits")),
        "secret-hits",
    )
    found = parts(hits).groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct(START, KIND, END))).alias("found")
    )
    rows = hits.select(ROW, "doc_id").join(stored(found, "secret-spans"), ROW, "left")
    spans = F.coalesce(F.col("found"), F.expr(f"cast(array() as array<struct<{START}:bigint,{KIND}:int,{END}:bigint>>)"))
    base = F.filter(spans, lambda s: s[KIND] < len(BASE_KINDS))

    def count(number: int) -> Column:
        return F.size(F.filter(spans, lambda s: s[KIND] == number)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)]
    return rows.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span replaced by a mask; ``n_chars`` follows the text.

    Only texts in which some pattern matches are numbered and shuffled; the others pass through.
    """
    suspect = F.coalesce(functools.reduce(operator.or_, [_sought(F.col("text"), p) for p in PARTS]), F.lit(False))
    some = stored(_numbered(docs.where(suspect)), "secret-texts")
    spans = parts(some.select(ROW, _all_matches(F.col("text")).alias("hits")))
    # spans that overlap or touch become one
    earlier = Window.partitionBy(ROW).orderBy(START, END).rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col(START) > F.max(END).over(earlier), F.lit(True))
    group = F.sum(F.col("fresh").cast("int")).over(Window.partitionBy(ROW).orderBy(START, END))
    merged = (
        spans.withColumn("fresh", fresh)
        .withColumn("stretch", group)
        .groupBy(ROW, "stretch")
        .agg(F.min(START).alias(START), F.max(END).alias(END))
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_list(F.struct(START, END))).alias("__found"))
    )
    found = stored(merged, "secret-masks")
    n = F.size("__found")
    kept = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.substring(
            F.col("text"),
            F.when(i == 0, 0).otherwise(F.get("__found", i - 1)[END]).cast("int") + 1,
            F.when(i == n, LONG)
            .otherwise(F.get("__found", i)[START] - F.when(i == 0, 0).otherwise(F.get("__found", i - 1)[END]))
            .cast("int"),
        ),
    )
    text = F.when(F.col("__found").isNotNull(), F.array_join(kept, MASK)).otherwise(F.col("text"))
    masked = some.join(found, ROW, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.col("__found").isNotNull(), length).otherwise(F.col("n_chars")))
    return docs.where(~suspect).unionByName(masked.select(*docs.columns))


def scan_sql() -> str:
    """``scan`` over ``documents`` for DuckDB."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    found = "\nUNION ALL\n".join(
        f"SELECT r, {i} AS kind, i, length(pieces[i]) AS gap, length(w[i]) AS len, length(g[i]) AS val FROM ("
        f"SELECT r, string_split_regex(t, {quoted(p.pattern)}) AS pieces, "
        f"regexp_extract_all(t, {quoted(p.pattern)}, 0) AS w, "
        f"regexp_extract_all(t, {quoted(p.pattern)}, {p.group}) AS g, unnest(range(1, len(w) + 1)) AS i "
        f"FROM d WHERE regexp_matches(t, {quoted(p.test)}))"
        for i, p in enumerate(PARTS)
    )
    counted = " OR ".join(f"kind = {i} AND val BETWEEN {p.least} AND {p.most}" for i, p in enumerate(PARTS))
    roles = []
    for role in ROLES:
        own = f"kind IN ({', '.join(str(i) for i, p in enumerate(PARTS) if p.role == role)})"
        before = f"max(CASE WHEN {own} THEN ends END) OVER earlier >= starts - {SCOPE}"
        after = f"min(CASE WHEN {own} THEN starts END) OVER later <= ends + {SCOPE}"
        roles.append(f"coalesce({before}, FALSE) OR coalesce({after}, FALSE) AS {role}")
    reported = " OR ".join(
        f"kind = {i}" + "".join(f" AND {role}" for role in ([] if p.base else NEEDS[p.role]))
        for i, p in enumerate(PARTS)
    )
    names = ", ".join(quoted(p.kind) for p in PARTS)
    base = len(BASE_KINDS)
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{kind}" for i, kind in enumerate(BASE_KINDS))
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    m AS ({found}),
    placed AS (
        SELECT *, ends - len AS starts
        FROM (SELECT *, sum(gap + len) OVER (PARTITION BY r, kind ORDER BY i) AS ends FROM m)
        WHERE {counted}),
    near AS (
        SELECT *, {", ".join(roles)} FROM placed
        WINDOW earlier AS (PARTITION BY r ORDER BY starts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            later AS (PARTITION BY r ORDER BY starts RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    s AS (SELECT r, kind, starts, ends, concat_ws(':', [{names}][kind + 1], starts, ends) AS span
          FROM near WHERE {reported}),
    g AS (
        SELECT r, {counts},
            string_agg(span, ',' ORDER BY starts, kind) FILTER (kind < {base}) AS base,
            string_agg(span, ',' ORDER BY starts, kind) AS spans
        FROM s GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)},
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (r)"""
