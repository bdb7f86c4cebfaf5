"""Registry of runnable queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.enrich import Tables
from fleetlens.plans.model import MODEL, tables
from fleetlens.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Types every client reads alike: 64-bit integers, doubles, text dates, zone-free timestamps."""

    def plain(field: T.StructField):
        col = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(field.name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(field.name)
        if isinstance(kind, T.DateType):
            return col.cast("string").alias(field.name)
        if isinstance(kind, T.TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(kind, T.NullType):
            return col.cast("string").alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``oracle`` may use ``{base_table}``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain_types(fn(tables(spark, sf_dir)))

        QUERIES[name] = Query(name, run, MODEL.oracle(oracle) if oracle else None)
        return fn

    return register


# ---------------------------------------------------------------------------
# Helpers to write the check SQL
# ---------------------------------------------------------------------------


def plain_sql(expr: str, dtype: T.DataType, name: str) -> str:
    """The same type plainness as ``plain_types`` on the SQL side."""
    if isinstance(dtype, T.DecimalType):
        return f"CAST({expr} AS DOUBLE) AS {name}"
    if isinstance(dtype, T.IntegerType):
        return f"CAST({expr} AS BIGINT) AS {name}"
    if isinstance(dtype, T.DateType):
        return f"CAST({expr} AS VARCHAR) AS {name}"
    return f"{expr} AS {name}"


MODEL.raw(
    "_dim",
    """
    SELECT a.id AS account_ref, a.account_id AS account, a.region AS account_region, a.account_name, a.account_type,
      a.category AS account_category, a.account_status, a.partner_name AS account_partner,
      a.customer_name AS account_customer, concat(a.account_id, '-', a.account_name) AS account_full,
      p.name AS project_product_name
    FROM {accounts} a
    LEFT JOIN (SELECT account_id, product_id, row_number() OVER (PARTITION BY account_id ORDER BY id) AS rank_no
               FROM {product_accounts}) f ON f.account_id = a.id AND f.rank_no = 1
    LEFT JOIN {products} p ON p.id = f.product_id
    """,
)
