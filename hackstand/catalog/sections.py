"""Bundles of small results as one long table: section, key, measure, value."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.catalog.registry import plain_times

NONE = "-"


def long_form(parts: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    frames = []
    for name, (df, keys, measures) in parts.items():
        df = plain_times(df)
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit(NONE)) for k in keys]) if keys else F.lit("")
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        frames.append(df.select(F.lit(name).alias("section"), key.alias("key"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, frames)


def section_sql(name: str, keys: list[str], measures: dict[str, str], source: str, tail: str = "") -> str:
    """SQL twin of one part: ``source`` is FROM .. WHERE .., keys are grouped when given."""
    key = "concat_ws('|', " + ", ".join(f"coalesce(cast({k} as varchar), '{NONE}')" for k in keys) + ")" if keys else "''"
    group = " group by " + ", ".join(keys) if keys else ""
    cols = ", ".join(f"cast({e} as double) as m{i}" for i, e in enumerate(measures.values()))
    inner = f"(select {key} as key, {cols} from {source}{group}{tail})"
    return " union all ".join(
        f"select '{name}' as section, key, '{m}' as measure, m{i} as value from {inner}" for i, m in enumerate(measures)
    )
