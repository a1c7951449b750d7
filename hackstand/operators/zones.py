"""Joins to the small lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_zone(df: DataFrame, zones: DataFrame, location: str, prefix: str, names=("borough", "zone")) -> DataFrame:
    """Add ``{prefix}borough`` and ``{prefix}zone`` by location.

    Left join without a hint: Catalyst broadcasts the lookup while it is below the
    threshold, and falls back to a shuffled join with skew splitting beyond it.
    """
    borough, zone = (f"{prefix}{n}" for n in names)
    lookup = zones.select(
        F.col("LocationID").alias("_loc"), F.col("Borough").alias(borough), F.col("Zone").alias(zone)
    )
    return df.join(lookup, F.col(location) == F.col("_loc"), "left").drop("_loc")


def with_lookup(df: DataFrame, table: DataFrame, on: str, key: str, value: str, alias: str) -> DataFrame:
    names = table.select(F.col(key).alias("_code"), F.col(value).alias(alias))
    return df.join(names, F.col(on) == F.col("_code"), "left").drop("_code")


def with_flat_fare(df: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Flat fare and name of the ratecode in the trip's fiscal year."""
    t = tariffs.select(
        F.col("ratecode_id").alias("_rc"), F.col("fiscal_year").alias("_fy"), "flat_fare", "ratecode_name"
    )
    return df.join(
        t, (F.col("ratecode_id") == F.col("_rc")) & (F.col("year") == F.col("_fy")), "left"
    ).drop("_rc", "_fy")
