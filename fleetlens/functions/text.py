"""String expressions shared by the views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_nulls_empty(*cols: Column | str) -> Column:
    """Concatenate, reading null as an empty string."""
    return F.concat(*[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def account_full(prefix: str = "") -> Column:
    return concat_nulls_empty(F.col(f"{prefix}account_id"), F.lit("-"), F.col(f"{prefix}account_name"))


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))
