"""Base tables on shared storage, split so that an upsert rewrites only what it touches.

Tables whose natural key holds a date are split by day; the others by a hash
of the key into buckets whose number doubles as the table grows.  New parts are
written beside the old ones and switched in at once (``versions``), and a batch
that names itself is applied once, however often it is tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.upsert import upsert
from fleetlens.schemas import TABLES
from fleetlens.session import configure, shared_dir
from fleetlens.sources.versions import VersionedParts, remove

PART = "part"
#: Mean size of a bucket beyond which their number doubles.
BUCKET_BYTES = 256 << 20


class TableStore:
    """Tables under ``root``; ``buckets`` is how many hash parts an undated table starts with."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 4):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def parts(self, table: str) -> VersionedParts:
        return VersionedParts(self.spark, self.path(table), (PART,))

    def exists(self, table: str) -> bool:
        return self.parts(table).manifest()["number"] > 0

    def dated(self, table: str) -> str | None:
        """The first date of the natural key."""
        spec = TABLES[table]
        return next((n for n in spec.key if isinstance(spec.columns[n], (T.DateType, T.TimestampType))), None)

    def bucket_count(self, table: str) -> int:
        return self.parts(table).manifest()["facts"].get("buckets", self.buckets)

    def part_of(self, table: str, buckets: int | None = None) -> Column:
        """Part label of a row, a function of its natural key alone."""
        day = self.dated(table)
        if day:
            return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("none"))
        return F.format_string("b%06d", F.pmod(F.xxhash64(*TABLES[table].key), F.lit(buckets or self.bucket_count(table))))

    def read(self, table: str, parts: list[str] | None = None) -> DataFrame:
        """The table, or only the given parts of it: other folders are not opened."""
        schema = TABLES[table].schema
        rows = self.parts(table).read(schema, parts)
        return self.spark.createDataFrame([], schema) if rows is None else rows.drop(PART)

    def committed(self, table: str, batch: tuple[str, int] | None) -> bool:
        return self.parts(table).committed(batch)

    def overwrite(self, table: str, df: DataFrame, parts: list[str] | None = None, batch: tuple[str, int] | None = None, buckets: int | None = None) -> DataFrame:
        """Make ``df`` the content of its parts (or of the whole table)."""
        buckets = buckets or self.bucket_count(table)
        rows = df.withColumn(PART, self.part_of(table, buckets)).repartition(PART)
        self.parts(table).replace(rows, parts, batch, {"buckets": buckets})
        return self.read(table)

    def _outgrown(self, table: str) -> int | None:
        """The next number of buckets if those there are have become too large."""
        if self.dated(table):
            return None
        size, buckets = sum(self.parts(table).manifest()["bytes"].values()), self.bucket_count(table)
        return 2 * buckets if size > buckets * BUCKET_BYTES else None

    def upsert(self, table: str, updates: DataFrame, mode: str, order_by, defaults, keys=None, batch: tuple[str, int] | None = None) -> DataFrame:
        """Upsert the touched parts and return the table.

        ``batch`` (source, number) is noted with the write: a batch that is
        there already changes nothing, rows with a null in the key included.
        The updates are computed once, into a staging folder that goes after
        the commit.
        """
        if self.committed(table, batch):
            return self.read(table)
        staging = shared_dir(self.spark, f"updates-{table}")
        try:
            updates.withColumn(PART, self.part_of(table)).write.parquet(staging)
            staged = self.spark.read.parquet(staging)
            # part labels only: at most the days or buckets of the batch
            touched = sorted(r[0] for r in staged.select(PART).distinct().collect())
            if touched:
                more = self._outgrown(table)
                base = self.read(table, None if more else touched)
                merged = upsert(base, staged.drop(PART), keys or TABLES[table].key, mode, order_by, defaults)
                return self.overwrite(table, merged, None if more else touched, batch, more)
            return self.read(table)
        finally:
            remove(self.spark, staging)
