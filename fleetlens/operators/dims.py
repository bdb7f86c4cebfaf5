"""Account dimension: one owning product and the ten account columns every view carries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import account_full

#: Columns an enrichment view adds to its fact.
ACCOUNT_COLUMNS = (
    "account",
    "account_region",
    "account_name",
    "account_type",
    "account_category",
    "account_status",
    "account_partner",
    "account_customer",
    "account_full",
    "project_product_name",
)


def first_product(links: DataFrame) -> DataFrame:
    """The product of each account's lowest link id.

    ``min_by`` combines on the map side; no per-account sort or window.
    """
    return links.groupBy("account_id").agg(F.min_by("product_id", "id").alias("product_id"))


def owning_product(links: DataFrame, products: DataFrame) -> DataFrame:
    """Account id -> name of its first product."""
    names = products.select(F.col("id").alias("product_id"), F.col("name").alias("project_product_name"))
    return first_product(links).join(names, "product_id", "left").drop("product_id")


def account_dimension(accounts: DataFrame, links: DataFrame, products: DataFrame) -> DataFrame:
    """``account_ref`` plus the ten account columns, one row per account row."""
    owned = owning_product(links, products).withColumnRenamed("account_id", "account_ref")
    return (
        accounts.select(
            F.col("id").alias("account_ref"),
            F.col("account_id").alias("account"),
            F.col("region").alias("account_region"),
            "account_name",
            "account_type",
            F.col("category").alias("account_category"),
            "account_status",
            F.col("partner_name").alias("account_partner"),
            F.col("customer_name").alias("account_customer"),
            account_full().alias("account_full"),
        )
        .join(owned, "account_ref", "left")
        .select("account_ref", *ACCOUNT_COLUMNS)
    )
