"""Monthly trip files, lookups, targets and inventories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.operators.cleaning import FILE, ROW
from hackstand.session import materialise
from hackstand.sources.footers import read_footers, read_grouped

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
DICTIONARY_SCHEMA = "nombre_campo string, tipo_dato string, valor string"
MONTH_FILE = r"/([^/]+)/(\d{4})-(\d{2})\.parquet"


def expand_targets(years: Iterable, categories=fv.SERVICES) -> list[tuple[str, int, int]]:
    """(category, year, month) list from whole years and (category, year, month or None) entries."""
    out = []
    for entry in years:
        if isinstance(entry, int):
            out += [(c, entry, m) for c in categories for m in range(1, 13)]
        else:
            category, year, month = entry
            out += [(category, year, m) for m in ([month] if month else range(1, 13))]
    return list(dict.fromkeys(out))


def targets_frame(spark: SparkSession, targets) -> DataFrame:
    return spark.createDataFrame(list(targets), "category string, year int, month int")


def month_path(root: str, category: str, year: int, month: int) -> str:
    return f"{root}/{category}/{year}-{month:02d}.parquet"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever storage its scheme names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def committed(spark: SparkSession, path: str) -> bool:
    """A folder counts only once its job has finished."""
    return exists(spark, f"{path}/_SUCCESS")


def read_month(spark: SparkSession, root: str, category: str, year: int, month: int) -> DataFrame | None:
    """One category-month with its file month and row positions; None if absent. Unreadable files raise."""
    path = month_path(root, category, year, month)
    if not exists(spark, path):
        return None
    frame = spark.read.parquet(path)
    return frame.select(
        "*", F.lit(year).alias("file_year"), F.lit(month).alias("file_month"),
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW),
    )


def month_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the category-months below ``root``, from one listing of the storage; a month is a file or a folder of files."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/*.parquet")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString() for status in found or ()]


def month_footers(spark: SparkSession, root: str, targets) -> DataFrame:
    """category, year, month with the footer of each of its files; months without a file have one row with the error ``absent``.

    A month whose folder holds no file has the error ``no data files``.
    """
    named = spark.createDataFrame([(n,) for n in month_names(spark, root)], "name string")
    keys = lambda c: [
        F.regexp_extract(c, MONTH_FILE, 1).alias("category"), F.regexp_extract(c, MONTH_FILE, 2).cast("int").alias("year"),
        F.regexp_extract(c, MONTH_FILE, 3).cast("int").alias("month")]
    dated = lambda df, c: df.filter(F.col(c).rlike(MONTH_FILE))
    wanted = targets_frame(spark, targets)
    on = ["category", "year", "month"]
    months = dated(named, "name").select(*keys(F.col("name")), F.lit(True).alias("named")).distinct()
    files = dated(listing(spark, root), "path").select("*", *keys(F.col("path"))).join(wanted, on, "left_semi")
    read = read_footers(files.select("path", "length")).select("*", *keys(F.col("path")))
    state = F.coalesce(F.col("error"), F.when(F.col("path").isNull(), F.when(F.col("named"), "no data files").otherwise("absent")))
    return wanted.join(months, on, "left").join(read, on, "left").select(*on, "path", "bytes", "rows", "columns", state.alias("error"))


def read_months(spark: SparkSession, root: str, targets, unreadable: list | None = None) -> dict[str, DataFrame]:
    """All months of each category as one frame, by one read per distinct schema; columns that came later are NULL before.

    An unreadable month raises, unless ``unreadable`` is given: then it is added there for the caller to handle. Absent months are left out.
    """
    footers = materialise(month_footers(spark, root, targets), "footers")
    bad = footers.filter("error is not null and error <> 'absent'").orderBy("category", "year", "month", "path").collect()
    if bad and unreadable is None:
        raise AnalysisException(f"unreadable months: {', '.join(f'{r.category} {r.year}-{r.month:02d} ({r.error})' for r in bad)}")
    skipped = {(r.category, r.year, r.month) for r in bad}
    for r in bad:
        if (r.category, r.year, r.month) not in {m[:3] for m in unreadable}:
            unreadable.append((r.category, r.year, r.month, r.error))
    if skipped:  # a month with one damaged file is not read in part
        footers = footers.join(F.broadcast(targets_frame(spark, skipped)), ["category", "year", "month"], "left_anti")
    path = F.col("_metadata.file_path")
    extra = [F.regexp_extract(path, MONTH_FILE, 2).cast("int").alias("file_year"), F.regexp_extract(path, MONTH_FILE, 3).cast("int").alias("file_month"),
             path.alias(FILE), F.col("_metadata.row_index").alias(ROW)]
    frames = {c: read_grouped(spark, footers.filter((F.col("category") == c) & F.col("path").isNotNull()), extra=extra) for c in dict.fromkeys(t[0] for t in targets)}
    return {c: frame for c, frame in frames.items() if frame is not None}


def zone_lookup(spark: SparkSession, csv: str) -> DataFrame:
    return spark.read.schema(ZONE_SCHEMA).option("header", True).csv(csv)


def store_zone_lookup(spark: SparkSession, csv: str, path: str) -> DataFrame:
    zone_lookup(spark, csv).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every parquet file below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(root).select("path", "length")


def partition_value(path, key: str):
    """A partition's value as its folder names it, with the writer's escapes undone (a space or slash is a percent code there)."""
    raw = F.regexp_extract(path, rf"/{key}=([^/]+)/", 1)
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def present_months(spark: SparkSession, root: str, category_key: str = "service_id") -> DataFrame:
    """Category-months of a partitioned table that hold at least one file whose footer can be read."""
    path = F.col("path")
    return read_footers(listing(spark, root)).filter("error is null").select(
        partition_value(path, category_key).alias("category"),
        partition_value(path, "year").cast("int").alias("year"),
        partition_value(path, "month").cast("int").alias("month"),
    ).distinct()


def missing_partitions(targets: DataFrame, present: DataFrame) -> DataFrame:
    return targets.join(present, ["category", "year", "month"], "left_anti")


def require_complete(targets: DataFrame, present: DataFrame, shown: int = 20) -> None:
    """Fail with the first missing category-months."""
    absent = missing_partitions(targets, present).orderBy("category", "year", "month").limit(shown).collect()
    if absent:
        names = ", ".join(f"{r.category} {r.year}-{r.month:02d}" for r in absent)
        raise FileNotFoundError(f"missing source months: {names}")


def inventory(spark: SparkSession, root: str, by=("service_id", "year", "month")) -> DataFrame:
    """Rows, files and bytes per partition; row counts come from the file footers."""
    files = spark.read.parquet(root).groupBy(
        *by, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return files.groupBy(*by).agg(
        F.sum("rows").alias("filas"), F.count(F.lit(1)).alias("archivos"), F.sum("bytes").alias("bytes"))


def inventory_pivot(counts: DataFrame) -> DataFrame:
    """Rows per month, one column per category."""
    return counts.groupBy("year", "month").pivot("service_id", list(fv.SERVICES)).agg(F.sum("filas"))


def scan_mart(spark: SparkSession, path: str, years=None, months=None, integers=()) -> DataFrame:
    """A partitioned mart, by one read per distinct schema; year and month choose the files, drifted number types are cast back."""
    files = listing(spark, path)
    limits = [(k, wanted) for k, wanted in (("year", years), ("month", months)) if wanted is not None]
    for key, wanted in limits:
        value = partition_value(F.col("path"), key)
        files = files.filter((value == "") | value.cast("int").isin(*wanted))
    df = read_grouped(spark, read_footers(files), path, integers)
    if df is None:  # no file is left: the table's own columns, without rows
        df = spark.read.option("basePath", path).parquet(path).limit(0)
    for key, wanted in limits:
        if key in df.columns:
            df = df.filter(F.col(key).isin(*wanted))
    return df.withColumns({c: F.col(c).cast("long") for c in integers if c in df.columns})
