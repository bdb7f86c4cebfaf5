"""Parquet tables for metric points and alarm snapshots, split by ISO week and, where bytes ask for it, day or hour."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timecalc import as_timestamp, iso_week
from fleetlens.operators.metrics import SNAPSHOT_KEY, SNAPSHOT_REPLACED, TIMESERIES_KEY, retain
from fleetlens.operators.upsert import merge_keyed
from fleetlens.session import configure, shared_dir
from fleetlens.sources.versions import VersionedParts, filesystem, label, remove

PARTITION = "iso_week"
SPAN = "span"
#: Bytes up to which a week stays one part; seven times as many are split by day, more by hour.
PART_BYTES = 64 << 20
#: Bytes of one file of a part.
FILE_BYTES = 128 << 20
#: Time parts of a week, from coarse to fine.
WEEK, DAY, HOUR = range(3)


def week_ranges(start: Column, weeks: int) -> Column:
    """Array of (iso_week, week_start, week_end) for ``weeks`` weeks from the Monday of ``start``."""
    monday = F.date_trunc("week", start).cast("date")
    mondays = F.transform(F.sequence(F.lit(0), F.lit(weeks - 1)), lambda i: F.date_add(monday, i * 7))
    return F.transform(
        mondays,
        lambda d: F.struct(
            iso_week(d).alias("iso_week"), d.alias("week_start"), F.date_add(d, 7).alias("week_end")
        ),
    )


def _parts(spark: SparkSession, path: str) -> VersionedParts:
    return VersionedParts(configure(spark), path, (PARTITION, SPAN))


def stored_weeks(spark: SparkSession, path: str) -> list[str]:
    """Week labels present under ``path``; no data is read."""
    return sorted({x.split("/")[0] for x in _parts(spark, path).labels()})


def read_timeseries(spark: SparkSession, path: str) -> DataFrame:
    """The whole table with its ``iso_week``."""
    return _parts(spark, path).read().drop(SPAN)


def _range(label: str) -> tuple[dt.datetime, dt.datetime]:
    """Start and end of a part."""
    week, span = label.split("/")
    if span == "all":
        start = dt.datetime.fromisocalendar(int(week[1:5]), int(week[5:]), 1)
        return start, start + dt.timedelta(days=7)
    if len(span) == 10:
        start = dt.datetime.strptime(span, "%Y-%m-%d")
        return start, start + dt.timedelta(days=1)
    start = dt.datetime.strptime(span, "%Y-%m-%d-%H")
    return start, start + dt.timedelta(hours=1)


def _grain_for(size: int) -> int:
    return WEEK if size <= PART_BYTES else DAY if size <= 7 * PART_BYTES else HOUR


def _weeks(manifest: dict) -> dict[str, tuple[int, int]]:
    """Time part and bytes of every stored week."""
    out: dict[str, tuple[int, int]] = {}
    for part, size in manifest["bytes"].items():
        week, span = part.split("/")
        grain = WEEK if span == "all" else DAY if len(span) == 10 else HOUR
        out[week] = grain, out.get(week, (grain, 0))[1] + size
    return out


def _span(grains: dict[str, int]) -> Column:
    """The time part that a row lies in; weeks that are not named stay whole."""
    days, hours = ([w for w, g in grains.items() if g == kind] for kind in (DAY, HOUR))
    week, when = F.col(PARTITION), F.col("collected_at")
    span = F.when(week.isin(days), F.date_format(when, "yyyy-MM-dd")) if days else F.when(F.lit(False), F.lit(""))
    return (span.when(week.isin(hours), F.date_format(when, "yyyy-MM-dd-HH")) if hours else span).otherwise(F.lit("all"))


def _laid_out(rows: DataFrame, grains: dict[str, int], sizes: dict[str, int], keys) -> DataFrame:
    """Rows in the files they go to: one file a part, or one per ``FILE_BYTES`` of a large part."""
    parts = {WEEK: 1, DAY: 7, HOUR: 168}
    pieces = {week: -(-sizes[week] // (parts[grain] * FILE_BYTES)) for week, grain in grains.items()}
    piece = F.lit(0)
    for n in sorted({n for n in pieces.values() if n > 1}):
        own = [w for w, m in pieces.items() if m == n]
        piece = F.when(F.col(PARTITION).isin(own), F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")).otherwise(piece)
    rows = rows.withColumn(SPAN, _span(grains)).withColumn("_piece", piece)
    return rows.repartition(PARTITION, SPAN, "_piece").sortWithinPartitions(PARTITION, SPAN, "account_id", "collected_at").drop("_piece")


def _merge(df: DataFrame, path: str, keys, replaced, order_by, batch) -> list[str]:
    """Merge a batch into the time parts it touches; others are neither read nor written.

    The instant is part of the key, so rows of other parts can't conflict.  A
    week is one part, or one per day or hour once its measured bytes ask for
    it, so a write costs by the bytes near its rows and not by the number of
    hours they span.  A week that outgrows its parts is split when next touched.
    """
    spark = configure(df.sparkSession)
    parts = _parts(spark, path)
    if parts.committed(batch):
        return []
    staging = shared_dir(spark, "points")
    try:
        df.withColumn(PARTITION, iso_week(F.col("collected_at"))).write.parquet(staging)
        staged = spark.read.parquet(staging)
        # labels only: bounded by the weeks of the batch
        touched = sorted(r[0] for r in staged.select(PARTITION).distinct().collect())
        if not touched:
            return []
        fs, folder = filesystem(spark, staging)
        arriving, manifest = fs.getContentSummary(folder).getLength(), parts.manifest()
        stored = _weeks(manifest)
        sizes = {w: stored.get(w, (WEEK, 0))[1] + arriving for w in touched}
        grains = {w: max(stored.get(w, (WEEK, 0))[0], _grain_for(sizes[w])) for w in touched}
        rows = staged.withColumn(SPAN, _span(grains))
        fine = [w for w in touched if grains[w] != WEEK]
        own = set()
        if fine:
            # at most the days or hours that the batch touches
            own = {r[0] for r in rows.filter(F.col(PARTITION).isin(fine)).select(label(F.col(PARTITION), F.col(SPAN))).distinct().collect()}
        split = {w for w in touched if w in stored and stored[w][0] != grains[w]}
        read = [x for x in manifest["parts"] if x.split("/")[0] in touched and (x in own or grains[x.split("/")[0]] == WEEK or x.split("/")[0] in split)]
        base = parts.read(rows.schema, read)
        merged = merge_keyed(base.drop(SPAN) if base is not None else None, staged, (PARTITION, *keys), replaced, order_by)
        parts.replace(_laid_out(merged, grains, sizes, keys), read, batch)
        return touched
    finally:
        remove(spark, staging)


def compact(spark: SparkSession, path: str) -> list[str]:
    """Put weeks whose parts have become too small for their time part into larger ones; returns these weeks."""
    parts = _parts(spark, path)
    manifest = parts.manifest()
    stored = _weeks(manifest)
    grains = {w: _grain_for(size) for w, (grain, size) in stored.items() if _grain_for(size) < grain}
    if grains:
        old = [x for x in manifest["parts"] if x.split("/")[0] in grains]
        rows = parts.read(None, old).drop(SPAN)
        parts.replace(_laid_out(rows, grains, {w: stored[w][1] for w in grains}, rows.columns), old)
    return sorted(grains)


def write_timeseries(df: DataFrame, path: str, order_by: tuple[str, ...] = (), batch: tuple[str, int] | None = None) -> list[str]:
    """Insert-or-update metric points; a conflict changes only ``value``.  Returns the weeks touched."""
    return _merge(df, path, TIMESERIES_KEY, ("value",), (*order_by, "dimensions"), batch)


def write_snapshots(df: DataFrame, path: str, order_by: tuple[str, ...] = (), batch: tuple[str, int] | None = None) -> list[str]:
    """Insert-or-update alarm snapshots; a conflict changes state, reason and state time."""
    return _merge(df, path, SNAPSHOT_KEY, SNAPSHOT_REPLACED, (*order_by, "state_updated_at"), batch)


def read_since(spark: SparkSession, path: str, since: dt.datetime) -> DataFrame:
    """Rows collected from ``since`` on; parts that end before are not opened."""
    parts = _parts(spark, path)
    rows = parts.read(None, [x for x in parts.labels() if _range(x)[1] > since])
    rows = read_timeseries(spark, path).limit(0) if rows is None else rows.drop(SPAN)
    return rows.filter(F.col("collected_at") >= as_timestamp(since))


def purge(spark: SparkSession, path: str, as_of: dt.datetime, days: int = 90) -> int:
    """M8 on disk: drop whole parts past retention, rewrite the boundary part; returns deleted rows.

    Counting the dropped parts reads only Parquet footers.
    """
    parts = _parts(spark, path)
    limit = as_of - dt.timedelta(days=days)
    labels = parts.labels()
    old, deleted = [x for x in labels if _range(x)[1] <= limit], 0
    if old:
        deleted += parts.read(None, old).count()
    boundary = [x for x in labels if _range(x)[0] < limit < _range(x)[1]]
    if boundary:
        rows = parts.read(None, boundary)
        kept = retain(rows, as_of, days)
        before, after = rows.count(), kept.count()
        deleted += before - after
        if after == 0:
            old += boundary
        elif after < before:
            parts.replace(kept, boundary)
    if old:
        parts.drop(old)
    return deleted
