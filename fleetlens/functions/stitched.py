"""Window functions over a key whose rows may be a large part of the table.

A plain window sorts all rows of a key in one task.  Here the rows of a key are
split by an order-preserving bucket (a day, a month); the window runs inside
each bucket and one summary row per bucket carries the state across.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _bucketed(df: DataFrame, bucket: Column) -> DataFrame:
    return df.withColumn("_bucket", bucket)


def previous_row(
    df: DataFrame, keys: list[str], order: list[str], bucket: Column, values: list[str], prefix: str = "previous_"
) -> DataFrame:
    """``lag`` of ``values`` by ``order`` within ``keys``.

    ``bucket`` must not decrease along ``order``.  Within a bucket ``lag`` runs
    as usual; the first row of a bucket takes the last row of the one before.
    """
    rows = _bucketed(df, bucket)
    last = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(W.partitionBy(*keys).orderBy("_bucket")))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_k_bucket"), "_carried")
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    lagged = rows.withColumn("_before", F.lag(F.struct(*values)).over(inside))
    same = F.col("_bucket") == F.col("_k_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    # only a bucket's first row looks at the carried state
    joined = lagged.join(last, same, "left")
    source = F.when(F.col("_before").isNotNull(), F.col("_before")).otherwise(F.col("_carried"))
    return joined.withColumn("_prev", source).select(
        *df.columns, *[F.col(f"_prev.{v}").alias(f"{prefix}{v}") for v in values]
    )


def running_max(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, out: str) -> DataFrame:
    """Running maximum of ``value`` by ``order`` within ``keys``, current row included."""
    rows = _bucketed(df, bucket)
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.max(value).alias("_top"))
        .withColumn("_carried", F.max("_top").over(before))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_k_bucket"), "_carried")
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.max(value).over(inside))
    same = F.col("_bucket") == F.col("_k_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return local.join(carried, same, "left").select(*df.columns, F.greatest("_local", "_carried").alias(out))
