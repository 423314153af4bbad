"""Joins whose rows stay evenly dealt to tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partner(key: Column) -> Column:
    """The key of a right side that `spread` rows are joined to."""
    return F.concat(F.lit("="), key)


def spread(rows: DataFrame, key: Column) -> Column:
    """The text key of a left join; rows without one, which can have no partner, get a hash of the row.

    By a null key all of them would go to one task. Columns with maps, which have no hash, are left out.
    """
    hashed = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    return F.coalesce(partner(key), F.xxhash64(*hashed).cast("string"))
