"""Keyed writes: last-wins merges, upserts, link replacement and schema evolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import TABLES

#: Never changed by an update once the row exists.
INSERT_ONLY = ("id", "created_at")


def row_id(table: str) -> Column:
    """Id of a new row, derived from its natural key."""
    return F.xxhash64(F.lit(table), *[F.col(k) for k in TABLES[table].key])


def _null_key(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def dedup_updates(updates: DataFrame, keys, mode: str, order_by) -> DataFrame:
    """One update per key, as if the rows had been applied in ``order_by`` order.

    ``full`` takes the last row whole; ``partial`` takes each column's last
    value that is not null.  Both are aggregates, so a hot key is combined on
    the map side and never sorted in one task.
    """
    keys, order = tuple(keys), F.struct(*order_by)
    values = [c for c in updates.columns if c not in keys and c not in order_by]
    if mode == "full":
        if not values:
            return updates.select(*keys).distinct()
        last = F.max_by(F.struct(*values), order)
        return updates.groupBy(*keys).agg(last.alias("_u")).select(*keys, "_u.*")
    if mode == "partial":
        present = lambda c: F.when(F.col(c).isNotNull(), order)
        return updates.groupBy(*keys).agg(*[F.max_by(c, present(c)).alias(c) for c in values])
    raise ValueError(f"mode must be 'full' or 'partial', not {mode!r}")


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys,
    mode: str = "full",
    order_by=(),
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Update-or-insert on a natural key; returns the new state of ``base``.

    Columns the updates do not carry keep their stored value.  In ``full`` mode
    a null that is carried overwrites; in ``partial`` mode it does not.  A row
    whose key holds a null matches nothing and is inserted, as SQL equality
    would have it.  ``order_by`` names the update columns that give the order
    within the batch; they are not stored.
    """
    keys = tuple(keys)
    defaults = defaults or {}
    keyless = updates.filter(_null_key(keys))
    latest = dedup_updates(updates.filter(~_null_key(keys)), keys, mode, tuple(order_by))
    carried = [c for c in latest.columns if c not in keys]
    renamed = latest.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in carried], F.lit(True).alias("_updated"))
    stored = base.withColumn("_stored", F.lit(True))
    joined = stored.join(renamed, list(keys), "full_outer")

    def value(name: str) -> Column:
        dtype = base.schema[name].dataType
        if name in keys:
            return F.col(name)
        old = F.col(name)
        if name not in carried:
            fresh = F.lit(defaults.get(name)).cast(dtype)
            return F.when(F.col("_stored"), old).otherwise(fresh)
        new = F.col(f"_new_{name}").cast(dtype)
        insert = F.coalesce(new, F.lit(defaults.get(name)).cast(dtype)) if mode == "partial" else new
        if name in INSERT_ONLY:
            changed = old
        elif mode == "partial":
            changed = F.coalesce(new, old)
        else:
            changed = F.when(F.col("_updated"), new).otherwise(old)
        return F.when(F.col("_stored"), changed).otherwise(insert)

    out = joined.select(*[value(c).alias(c) for c in base.columns])
    inserts = keyless.drop(*order_by)
    fill = {c: F.lit(defaults.get(c)).cast(base.schema[c].dataType) for c in base.columns if c not in inserts.columns}
    inserts = inserts.withColumns(fill) if fill else inserts
    return out.unionByName(
        inserts.select(*[F.col(c).cast(base.schema[c].dataType).alias(c) for c in base.columns])
    )


def upsert_stats(base: DataFrame, updates: DataFrame, keys, skipped: DataFrame | None = None) -> DataFrame:
    """One row of created / updated / skipped counts for a batch.

    The first row of a new key creates it, every other row updates.
    """
    keys = list(keys)
    per_key = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    known = base.select(*keys).distinct().withColumn("_stored", F.lit(True))
    joined = per_key.join(known, keys, "left")
    keyless = _null_key(tuple(keys))
    created = (
        F.when(keyless, F.col("n")).when(F.col("_stored"), F.lit(0)).otherwise(F.lit(1))
    )
    counts = joined.agg(
        F.coalesce(F.sum(created), F.lit(0)).alias("created"),
        F.coalesce(F.sum(F.col("n") - created), F.lit(0)).alias("updated"),
    )
    if skipped is None:
        return counts.withColumn("skipped", F.lit(0).cast("bigint"))
    rejected = skipped.agg(F.count(F.lit(1)).alias("skipped"))
    union = counts.unionByName(rejected, allowMissingColumns=True)
    return union.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in union.columns])


def merge_keyed(
    stored: DataFrame | None, updates: DataFrame, keys, replaced, order_by=()
) -> DataFrame:
    """Insert-or-update where a conflict changes only ``replaced``.

    The first row of a key (stored rows come first) gives every other column,
    the last one gives ``replaced``.  One aggregate over the union; columns of
    ``order_by`` that belong to the table stay in it.
    """
    keys, replaced = tuple(keys), tuple(replaced)
    columns = stored.columns if stored is not None else updates.columns
    order = [c for c in order_by if c in updates.columns]
    tagged = updates.select(*columns, F.lit(1).alias("_seq"), F.struct(*order, *[f for f in replaced]).alias("_order"))
    if stored is not None:
        earlier = stored.select(*columns, F.lit(0).alias("_seq"))
        tagged = earlier.unionByName(tagged, allowMissingColumns=True)
    kept = [c for c in columns if c not in keys and c not in replaced]
    position = F.struct("_seq", "_order")
    aggs = [F.max_by(F.struct(*replaced), position).alias("_last")]
    if kept:
        aggs.append(F.min_by(F.struct(*kept), position).alias("_first"))
    merged = tagged.groupBy(*keys).agg(*aggs)
    source = {**{c: c for c in keys}, **{c: f"_last.{c}" for c in replaced}, **{c: f"_first.{c}" for c in kept}}
    return merged.select(*[F.col(source[c]).alias(c) for c in columns])


def replace_links(links: DataFrame, new_links: DataFrame) -> DataFrame:
    """Drop links of touched accounts that the new list does not hold.

    Accounts without a new link keep all of theirs.
    """
    touched = new_links.select("account_id").distinct()
    current = new_links.select("account_id", "product_id").distinct()
    untouched = links.join(touched, "account_id", "left_anti")
    confirmed = links.join(current, ["account_id", "product_id"], "left_semi")
    return untouched.unionByName(confirmed)


def link_product(
    products: DataFrame, accounts: DataFrame, links: DataFrame, name: str, account_ids: DataFrame | list[str]
) -> DataFrame:
    """Links after mapping product ``name`` to every row of the given account numbers.

    The numbers are a list, or a table with a column ``account_id``.  Names are
    unique; should one repeat, the lowest id counts.
    """
    if isinstance(account_ids, DataFrame):
        chosen = accounts.join(account_ids.select("account_id").distinct(), "account_id", "left_semi")
    else:
        chosen = accounts.filter(F.col("account_id").isin(*account_ids))
    product = products.filter(F.col("name") == name).agg(F.min("id").alias("product_id")).scalar()
    wanted = chosen.select(product.alias("product_id"), F.col("id").alias("account_id")).filter("product_id IS NOT NULL")
    fresh = wanted.select("product_id", "account_id").join(
        links.select("product_id", "account_id"), ["product_id", "account_id"], "left_anti"
    )
    return links.unionByName(fresh, allowMissingColumns=True)


def remove_product(products: DataFrame, links: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(products, links) without product ``name``."""
    gone = products.filter(F.col("name") == name).select(F.col("id").alias("product_id"))
    return products.filter(F.col("name") != name), links.join(gone, "product_id", "left_anti")


def evolve_table(df: DataFrame, table: str) -> DataFrame:
    """Bring an older layout to the catalog's: add columns, fill defaults, order and cast."""
    spec = TABLES[table]

    def column(name: str) -> Column:
        dtype = spec.columns[name]
        default = F.lit(spec.defaults.get(name)).cast(dtype)
        if name not in df.columns:
            return default.alias(name)
        return F.col(name).cast(dtype).alias(name)

    return df.select(*[column(c) for c in spec.columns])


def resolve_account(df: DataFrame, accounts: DataFrame, column: str = "account_id") -> DataFrame:
    """Replace an account number by the account row's id; unknown numbers become null.

    A number that occurs in several regions takes its lowest id.
    """
    ids = accounts.groupBy(F.col("account_id").alias("_number")).agg(F.min("id").alias("_id"))
    joined = df.join(ids, F.col(column) == F.col("_number"), "left")
    return joined.select(*[F.col("_id").alias(c) if c == column else F.col(c) for c in df.columns])
