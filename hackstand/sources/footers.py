"""Parquet footers: files read, judged and grouped by schema without reading their rows.

One job reads the footers, a file per row; the driver then plans one read per distinct schema, however many months or folders
hold it. Files are listed by Spark; footers are opened by Arrow, which takes its credentials from the environment of the workers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand.operators.columns import union_drift

FOOTER_SCHEMA = "path string, bytes long, rows long, columns array<struct<name:string,kind:string>>, error string"
#: Schemes that Hadoop and Arrow name differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfss": "abfs"}
WHOLE = {"tinyint", "smallint", "int", "bigint"}
NUMBERS = WHOLE | {"float", "double"}


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a Hadoop path, and the path within it; names are taken as they stand, escapes included."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    authority, _, key = rest.lstrip("/").partition("/")
    system, base = fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{authority}/")
    return system, f"{base.rstrip('/')}/{key}"


def footer(path: str) -> tuple[int | None, list[dict] | None, str | None]:
    """(rows, columns, error) of one file. A damaged footer is an answer; a storage that cannot be reached is not."""
    system, name = locate(path)
    with system.open_input_file(name) as source:
        try:
            meta = pq.ParquetFile(source)
            return meta.metadata.num_rows, [{"name": f.name, "kind": str(f.type)} for f in meta.schema_arrow], None
        except (pa.ArrowException, OSError) as error:
            return None, None, str(error).splitlines()[0]


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string())]))
    for batch in batches:
        paths = batch.column("path").to_pylist()
        rows, columns, errors = zip(*[footer(p) for p in paths]) if paths else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("length"), pa.array(rows, pa.int64()), pa.array(columns, kind), pa.array(errors, pa.string())],
            ["path", "bytes", "rows", "columns", "error"])


def read_footers(files: DataFrame) -> DataFrame:
    """path, bytes, rows, columns and error (NULL if readable) of each file of ``files`` (path, length)."""
    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path", "length").repartition(tasks, "path").mapInArrow(_footers, FOOTER_SCHEMA)


def schema_groups(footers: DataFrame, *keys: str) -> DataFrame:
    """Per ``keys`` and distinct list of columns: files, rows and bytes. Unreadable files form groups of their own without columns."""
    return footers.groupBy(*keys, "columns").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count("error").alias("unreadable"))


def drift_report(footers: DataFrame, *keys: str) -> DataFrame:
    """Columns that some groups of files (``keys``) have and others lack: name, kinds, in how many groups, and of how many."""
    parts = footers.filter("error is null").select(*keys, F.explode("columns").alias("c")).select(*keys, "c.*").distinct()
    groups = footers.filter("error is null").select(*keys).distinct().agg(F.count(F.lit(1)).alias("groups"))
    held = parts.groupBy("name").agg(
        F.sort_array(F.collect_set("kind")).alias("kinds"), F.count_distinct(*keys).alias("present"))
    # one row of totals meets one row per column
    return held.join(F.broadcast(groups), F.col("present") < F.col("groups"))


def literal(path: str) -> str:
    """A path whose pattern signs stand for themselves."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def read_grouped(spark: SparkSession, footers: DataFrame, base_path: str | None = None, integers=(), extra=()) -> DataFrame | None:
    """All rows of the files, one read per distinct schema; None if there is no file. An unreadable file raises.

    Columns that some files lack are NULL there. Where number kinds differ between files, whole numbers become long and others
    double, those of ``integers`` long. A partition key that reads as a number in one group and as text in another is text.
    The driver holds the file names, as Spark's own index of a table does.
    """
    found = footers.groupBy(F.col("error").isNull().alias("good"), "columns").agg(F.sort_array(F.collect_list("path")).alias("paths"), F.min("error").alias("error"))
    groups = found.select("good", F.col("columns.name").alias("names"), "paths", "error").collect()  # one row per distinct schema
    bad = [g for g in groups if not g["good"]]
    if bad:
        raise AnalysisException(f"unreadable files: {', '.join(bad[0]['paths'][:20])} ({bad[0]['error']})")
    groups.sort(key=lambda g: g["paths"][0])
    if not groups:
        return None

    def read(group, schema=None):
        reader = spark.read.option("basePath", base_path) if base_path else spark.read
        return (reader.schema(schema) if schema else reader).parquet(*[literal(p) for p in group["paths"]])

    frames = [read(g) for g in groups]
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    own = set().union(*[set(g["names"]) for g in groups])
    as_text = {n for n, found in kinds.items() if n not in own and len(found) > 1 and "string" in found}
    if as_text:
        frames = [read(g, ", ".join(f"`{n}` {'string' if n in as_text else kind}" for n, kind in f.dtypes)) for g, f in zip(groups, frames)]
    wide = {n: "long" if n in integers or found <= WHOLE else "double" for n, found in kinds.items() if len(found) > 1 and found <= NUMBERS}
    return union_drift([
        f.select("*", *extra).withColumns({n: F.col(f"`{n}`").cast(kind) for n, kind in wide.items() if n in f.columns}) for f in frames])
