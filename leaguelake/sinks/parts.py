"""Tables in parts, of which an update rewrites only those it touches.

Rows belong to one of ``buckets`` parts by a hash of their key. An update writes the touched parts anew
to a directory of its own and then a manifest that says which update holds each part's rows now. Readers
follow the newest finished manifest: they see the table before the update or after it, never between, and
every row once. An update that is repeated under its number starts from the manifest before it, so it
leaves the same rows. The manifest has one row per part, however many rows and updates there are; choose
``buckets`` so that a part has some hundred megabytes. Updates of one table follow one another.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.operators.dedup import latest
from leaguelake.scale import stored

PART, UPDATE = "part", "update"
MANIFEST = f"{PART} int, held_by long, buckets int"


@dataclass(frozen=True)
class PartTable:
    path: str
    key: tuple[str, ...]
    buckets: int = 64

    def _folder(self, kind: str, update: int) -> str:
        return f"{self.path.rstrip('/')}/{kind}/{UPDATE}={update}"

    def updates(self, spark: SparkSession) -> list[int]:
        """Numbers of the finished updates, in order."""
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/manifest")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        done = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{UPDATE}=*/_SUCCESS"))
        return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in done)

    def live(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """Which update holds each part's rows, as of the newest update (below ``before``)."""
        known = [n for n in self.updates(spark) if before is None or n < before]
        if not known:
            return {}
        rows = spark.read.schema(MANIFEST).json(self._folder("manifest", known[-1])).collect()
        if any(r["buckets"] != self.buckets for r in rows):
            raise ValueError(f"{self.path} has {rows[0]['buckets']} parts, not {self.buckets}")
        return {r[PART]: r["held_by"] for r in rows}

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(
        self, spark: SparkSession, parts: Collection[int] | None = None, before: int | None = None
    ) -> DataFrame | None:
        """The rows of all parts, or of ``parts``, whose directories alone are listed; None without any."""
        held = self.live(spark, before).items()
        paths = [f"{self._folder('data', n)}/{PART}={p}" for p, n in held if parts is None or p in parts]
        return spark.read.parquet(*sorted(paths)) if paths else None

    def replace(self, rows: DataFrame, touched: Collection[int], update: int) -> None:
        """Make ``rows`` all there is in the ``touched`` parts; none of them may lie in another part."""
        spark = rows.sparkSession
        held = {p: n for p, n in self.live(spark, update).items() if p not in touched}
        folder = self._folder("data", update)
        # large parts are written by several tasks, small ones by one together
        placed = rows.withColumn(PART, self.part_of()).hint("rebalance", F.col(PART))
        placed.write.mode("overwrite").partitionBy(PART).parquet(folder)
        written = spark.read.schema(f"{PART} int").parquet(folder).select(PART).distinct().collect()
        held |= {r[PART]: update for r in written}
        manifest = [(p, n, self.buckets) for p, n in sorted(held.items())]
        spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.mode("overwrite").json(
            self._folder("manifest", update)
        )

    def upsert(self, rows: DataFrame, newest_first: Sequence[Column], update: int) -> None:
        """Add ``rows``; of each key the first in the order ``newest_first`` stays.

        Rows without a key are no copies of each other: all stay, a repeated row as well.
        """
        spark = rows.sparkSession
        new = stored(rows, "upsert")
        touched = {r[PART] for r in new.select(self.part_of().alias(PART)).distinct().collect()}
        old = self.read(spark, touched, update)
        both = new if old is None else old.unionByName(new)
        self.replace(latest(both, list(self.key), newest_first), touched, update)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete the files that none of the newest ``keep`` manifests names, and older manifests."""
        done = self.updates(spark)
        last = done[-max(keep, 1) :]
        named = {(n, p) for m in last for p, n in self.live(spark, m + 1).items()}
        hadoop = spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for n in done:
            folder = self._folder("data", n)
            for status in files.globStatus(hadoop.Path(f"{folder}/{PART}=*")) or []:
                part = int(status.getPath().getName().split("=")[1])
                if (n, part) not in named:
                    files.delete(status.getPath(), True)
            if n not in last:
                files.delete(hadoop.Path(self._folder("manifest", n)), True)
