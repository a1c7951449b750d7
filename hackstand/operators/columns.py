"""Schema harmonisation at plan time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackstand import fixed_values as fv


def first_match(columns, candidates, ignore_case: bool = True) -> str | None:
    """The first candidate present, spelled as the source spells it."""
    fold = str.lower if ignore_case else str
    present = {fold(name): name for name in columns}
    return next((present[fold(c)] for c in candidates if fold(c) in present), None)


def col_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def safe_select(df: DataFrame, *items) -> DataFrame:
    """Select, skipping names the source does not have; expressions are always kept."""
    kept = [i for i in items if isinstance(i, Column) or i in df.columns]
    return df.select(*kept)


def normalize_types(df: DataFrame) -> DataFrame:
    """Code columns to int; values stay as they are."""
    return df.withColumns({c: F.col(c).cast("int") for c in fv.CODE_COLUMNS if c in df.columns})


def union_drift(frames) -> DataFrame:
    """Union by name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def schema_diff(df: DataFrame, known) -> dict[str, list[str]]:
    """Columns not in ``known``, and known ones that are missing."""
    have, want = set(df.columns), set(known)
    return {"unknown": sorted(have - want), "missing": sorted(want - have)}
