"""URLs by rules, and the rest by the ratio of two character models.

Rules name hosts with their subdomains and the start of a path; the longest that fits decides. The
URLs that rules decide also teach: two variable-order Markov models over characters, one of accepted
and one of rejected URLs, interpolated from order 0 to 4 by the number of different successors of a
context (Witten-Bell). An URL's log-likelihood difference per character is compared with a cut that
separates held-out rule-decided URLs best; each distinct URL teaches once.

Both models are tables of real contexts and counts, so they grow with the input and nothing shares a
row. What a character adds to the difference depends on it and the four before it alone: each distinct
run of five characters is scored once, by joins of its suffixes with the counts, and an URL's score is
the sum over its runs, joined by run. Tables are stored, so Spark broadcasts small ones and shuffles
large ones. Differences are whole millionths: sums have one value in whatever order they are added up.

Rules see host and path, the models the whole URL with scheme, query and fragment, A-Z lower-cased.
Defined cases: a NULL URL, or one without ``://``, has empty host and path and no rule; a NULL or empty
URL scores 0; a NUL character counts as an edge; if rules decide no URL of one kind, the models say
nothing and the verdict is allow; repeated rows are judged alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.scale import stored

UPPER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str  # begins with a slash

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

ORDER = 4
EDGE = "\0"  # stands before the first and after the last character
SIDES = ("accepted", "rejected")
MILLIONTHS = 1_000_000
BIN, BINS = 0.01, 2000  # histogram of held-out scores


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, "(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER_LETTERS, UPPER_LETTERS.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, the name and the verdict of the longest rule that fits, and the text models see."""
    url = F.col("url").cast("string")
    host, path = split_url(url)
    address = F.translate(F.coalesce(url, F.lit("")), UPPER_LETTERS, UPPER_LETTERS.lower())
    split = pages.select(
        F.col("page_id").cast("long"), host.alias("host"), path.alias("path"), address.alias("address")
    )
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (F.concat(F.lit("."), F.col("host")).endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return split.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), "address")


def runs(address: Column) -> Column:
    """For every character of a text, and for its end, the character with the four before it."""
    line = F.split(F.concat(F.lit(EDGE * ORDER), address, F.lit(EDGE)), "")

    def of(line: Column) -> Column:
        last = F.slice(line, ORDER + 1, F.size(line))
        return F.transform(last, lambda c, i: F.concat(*(F.get(line, i + k) for k in range(ORDER)), c))

    # inside an array the line is split once; a lambda's body would split it for every character
    return F.get(F.transform(F.array(line), of), F.lit(0))


def run_counts(lessons: DataFrame) -> DataFrame:
    """run, and how often accepted and rejected texts hold it; ``lessons`` has address and accepted."""
    n = F.when(F.col("accepted"), 1).otherwise(0)
    return (
        lessons.select(F.explode(runs(F.col("address"))).alias("run"), n.alias("accepted"))
        .groupBy("run")
        .agg(F.sum("accepted").alias("accepted"), F.sum(1 - F.col("accepted")).alias("rejected"))
    )


def _suffix(order: int) -> Column:
    return F.substring("run", ORDER + 1 - order, order + 1)


def _context(order: int) -> Column:
    return F.substring("run", ORDER + 1 - order, order)


def _probability(side: str, characters: int) -> Column:
    """Witten-Bell from order 0 up; a context never seen leaves the shorter one's value."""
    p = F.lit(1.0 / (characters + 1))
    for order in range(ORDER + 1):
        n, total, kinds = (F.coalesce(F.col(f"{side}_{what}{order}"), F.lit(0)) for what in ("n", "total", "kinds"))
        weight = F.when(total > 0, kinds).otherwise(1)
        p = (n + weight * p) / (total + weight)
    return p


def run_scores(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """run, and by how many millionths its last character is likelier after the others in accepted texts.

    ``wanted`` has distinct runs; ``counts`` is stored.
    """
    characters = counts.select(_suffix(0)).distinct().count()
    scored = wanted
    for order in range(ORDER + 1):
        cells = counts.groupBy(_suffix(order).alias(f"suffix{order}")).agg(
            *(F.sum(side).alias(f"{side}_n{order}") for side in SIDES)
        )
        cells = stored(cells, "url-cells") if order else cells
        contexts = cells.groupBy(F.substring(f"suffix{order}", 1, order).alias(f"context{order}")).agg(
            *(F.sum(f"{side}_n{order}").alias(f"{side}_total{order}") for side in SIDES),
            *(F.count_if(F.col(f"{side}_n{order}") > 0).alias(f"{side}_kinds{order}") for side in SIDES),
        )
        scored = scored.join(cells, _suffix(order) == F.col(f"suffix{order}"), "left")
        scored = scored.join(stored(contexts, "url-contexts"), _context(order) == F.col(f"context{order}"), "left")
    accepted, rejected = (F.log(_probability(side, characters)) for side in SIDES)
    return scored.select("run", F.round((accepted - rejected) * MILLIONTHS).cast("long").alias("score"))


def with_log_ratio(addresses: DataFrame, counts: DataFrame) -> DataFrame:
    """``addresses``, stored and with a number for each row, and the mean difference over its characters."""
    lines = addresses.where("address != ''").select("number", F.explode(runs(F.col("address"))).alias("run"))
    scores = stored(run_scores(lines.select("run").distinct(), counts), "url-runs")
    sums = lines.join(scores, "run").groupBy("number").agg((F.sum("score") / F.count("score") / MILLIONTHS).alias("log_ratio"))
    return addresses.join(sums, "number", "left").withColumn("log_ratio", F.coalesce("log_ratio", F.lit(0.0)))


def best_cut(bins: dict[tuple[int, bool], int]) -> float:
    """The lower edge of the bin from which on accepting errs least, both kinds weighing the same."""
    table = np.zeros((BINS, 2))
    for (bin_number, accepted), n in bins.items():
        table[bin_number, int(accepted)] += n
    table /= np.maximum(table.sum(0), 1)
    below = np.vstack([np.zeros(2), np.cumsum(table, 0)])
    error = below[:, 1] + (1 - below[:, 0])
    edges = (np.arange(BINS + 1) - BINS // 2) * BIN
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, log_ratio."""
    rows = ruled(pages, rules)
    # equal addresses of different letter case may be decided differently: then they teach both
    distinct = rows.groupBy("address").agg(
        F.bool_or(F.col("ruled") == "allow").alias("allowed"), F.bool_or(F.col("ruled") == "block").alias("blocked")
    )
    addresses = stored(distinct.withColumn("number", F.monotonically_increasing_id()), "url-addresses")
    held_out = F.crc32(F.col("address").cast("binary")) % 5 == 0
    sides = F.array_compact(F.array(F.when(F.col("allowed"), True), F.when(F.col("blocked"), False)))
    taught = addresses.where(~held_out).select("address", F.explode(sides).alias("accepted"))
    counts = stored(run_counts(taught), "url-counts")
    seen = counts.agg(*(F.coalesce(F.sum(side), F.lit(0)).alias(side) for side in SIDES)).first()
    if not seen["accepted"] or not seen["rejected"]:
        return rows.select(
            "page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("log_ratio")
        )
    scored = stored(with_log_ratio(addresses, counts), "url-scores")
    bin_number = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(F.col("log_ratio") / BIN) + BINS // 2))
    tests = scored.where(held_out).select(bin_number.cast("int").alias("bin"), F.explode(sides).alias("accepted"))
    bins = tests.groupBy("bin", "accepted").count().collect()  # BINS rows a kind
    cut = best_cut({(r["bin"], r["accepted"]): r["count"] for r in bins}) if bins else 0.0
    own = F.when(F.col("log_ratio") >= cut, "allow").otherwise("block")
    return rows.join(scored.select("address", "log_ratio"), "address").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "log_ratio"
    )
