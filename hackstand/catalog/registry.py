"""Named queries over the given tables, each with the SQL that says the same thing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable
    sql: str | None


QUERIES: dict[str, Query] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that both engines print them alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


def runner(entry: Query, open_tables) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(entry.build(open_tables(spark, sf_dir)))

    run.__name__ = entry.name
    return run
