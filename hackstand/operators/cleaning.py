"""Reject-only cleaning: every row ends clean or rejected with its first failing rule.

All months of all categories go through one job; the file a row came from is a set of
columns (``scope``), not a loop.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions.numeric import count_where
from hackstand.operators.columns import first_match, normalize_types
from hackstand.operators.selection import top_n_per_group
from hackstand.session import materialise

REASON = "_reject_reason"
FILE, ROW = "_file", "_row"
#: Keys are counted in this many hash buckets; a bucket is hot beyond ``HOT_ROWS`` rows and ``HOT_SHARE`` of all, so at most 1,000 are.
BUCKETS, HOT_ROWS, HOT_SHARE = 1 << 18, 16, 0.001


@dataclass(frozen=True)
class TripRoles:
    """Which source column plays which part."""

    required: tuple[str, ...]
    pickup: str | None
    dropoff: str | None
    pu: str | None
    do: str | None
    keys: tuple[str, ...]
    prefer: tuple[str, ...] = ("total_amount", "driver_pay")
    scope: tuple[str, ...] = ("file_year", "file_month")
    file_year: str | None = "file_year"
    file_month: str | None = "file_month"


def roles_for(category: str, columns, nullable=None, scope=("file_year", "file_month")) -> TripRoles:
    """Resolve the roles of a raw category file from its column names."""
    data = [c for c in columns if not c.startswith("_") and c not in scope]
    optional = {n.lower() for n in (nullable or fv.NULLABLE).get(category, ())}
    spelled = {c.lower(): c for c in data}
    return TripRoles(
        required=tuple(c for c in data if c.lower() not in optional),
        pickup=first_match(data, fv.PICKUP_NAMES),
        dropoff=first_match(data, fv.DROPOFF_NAMES),
        pu=first_match(data, fv.PU_NAMES),
        do=first_match(data, fv.DO_NAMES),
        keys=tuple(spelled[k.lower()] for k in fv.TRIP_KEYS.get(category, ()) if k.lower() in spelled),
        prefer=tuple(c for c in ("total_amount", "driver_pay") if c in data),
        scope=tuple(scope),
    )


def with_position(df: DataFrame) -> DataFrame:
    """Attach where each row lies in its file: stable across retries, unique, layout-free."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def incomplete_reason(required) -> Column | None:
    tests = [F.when(F.col(c).isNull(), F.lit(f"incomplete_{c}")) for c in required]
    return F.coalesce(*tests) if tests else None


def timeliness_reason(roles: TripRoles) -> Column | None:
    if roles.pickup is None or roles.file_year is None:
        return None
    pickup = F.col(roles.pickup)
    on_time = (F.year(pickup) == F.col(roles.file_year)) & (F.month(pickup) == F.col(roles.file_month))
    return F.when(pickup.isNotNull() & ~on_time, F.lit("timeliness_off_period"))


def datetime_reason(roles: TripRoles) -> Column | None:
    """Strictly inverted trips only; equal times and long trips pass, unreadable text too."""
    if roles.pickup is None or roles.dropoff is None:
        return None
    start, end = (F.col(c).try_cast("timestamp") for c in (roles.pickup, roles.dropoff))
    return F.when(end < start, F.lit("datetime_inverted"))


def flag_known_zone(df: DataFrame, zones: DataFrame, location: str, flag: str) -> DataFrame:
    """Left join to the zone ids; no hint, so Catalyst broadcasts only what is small enough."""
    ids = zones.select(F.col("LocationID").alias(flag)).distinct()
    return df.join(ids, F.col(location) == F.col(flag), "left")


def key_hash(columns) -> Column:
    """64 bits of a key; unequal keys may share them."""
    return F.xxhash64(*columns)


def key_bucket(roles: TripRoles) -> Column:
    return F.pmod(key_hash([*roles.scope, *roles.keys]), F.lit(BUCKETS))


def hot_buckets(df: DataFrame, roles: TripRoles) -> list[int]:
    """Buckets whose trips are too many for one task. The shuffle carries a count per bucket and task, whatever the number of trips."""
    counts = materialise(df.groupBy(key_bucket(roles).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")), "key_buckets")
    least = counts.select(F.greatest(F.lit(HOT_ROWS), F.sum("_n") * HOT_SHARE).alias("_least"))
    return [r["_bucket"] for r in counts.join(least, F.col("_n") > F.col("_least")).select("_bucket").collect()]


def _content(df: DataFrame, roles: TripRoles) -> Column:
    """A hash of all columns that neither are part of the key nor order its trips."""
    rest = [c for c in df.columns if c not in (FILE, ROW, REASON, *roles.scope, *roles.keys, *roles.prefer)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0).cast("long")


def _mark_surplus(flagged: DataFrame, roles: TripRoles, contender: Column, hot: list[int]) -> DataFrame:
    """``_surplus`` on all contenders but the best of each key.

    Trips are ranked beside the others of their key, without a join; those that lie together by a part of the key stay where they are.
    Trips of hot buckets are dealt by position instead and marked from ``surplus_trips``, as no task could rank a key with a large share of all.
    """
    by = [*roles.scope, *roles.keys]
    crowded = key_bucket(roles).isin(hot) if hot else F.lit(False)
    rows = flagged.withColumns({"_content": _content(flagged, roles), "_contender": contender, "_deal": F.when(crowded, F.xxhash64(FILE, ROW))})
    if hot:
        rows = rows.repartition(*by, "_deal")  # an exchange of its own, so that hot joins below it are split
    order = [F.col(c).desc_nulls_last() for c in (*roles.prefer, "_content", FILE, ROW)]
    place = F.row_number().over(Window.partitionBy(*by, "_contender", "_deal").orderBy(*order))
    marked = rows.withColumn("_surplus", F.col("_contender") & F.col("_deal").isNull() & (place > 1)).drop("_content", "_contender", "_deal")
    if not hot:
        return marked
    surplus = surplus_trips(flagged.filter(contender & crowded).drop(REASON), roles)
    same = (F.col(FILE) == F.col("_surplus_file")) & (F.col(ROW) == F.col("_surplus_row"))
    return marked.join(surplus, same, "left").withColumn("_surplus", F.col("_surplus") | F.col("_surplus_row").isNotNull())


def surplus_trips(df: DataFrame, roles: TripRoles) -> DataFrame:
    """Positions (file, row) of all trips but the best of each key: largest amounts, then content, then position.

    Keys are counted by a hash of fixed width first; only trips whose hash repeats are compared by their whole keys. The best of a
    key is cut to one candidate per task before the shuffle, so a key that holds a third of all rows is no burden. The
    narrow columns are written once: the trips themselves are read once here and once where they are tagged.
    """
    by = [*roles.scope, *roles.keys]
    keys, amounts = [f"_k{i}" for i in range(len(by))], [f"_p{i}" for i in range(len(roles.prefer))]
    narrow = materialise(df.select(
        key_hash(by).alias("_hash"), *[F.col(c).alias(k) for c, k in zip(by, keys)], *[F.col(c).alias(p) for c, p in zip(roles.prefer, amounts)],
        _content(df, roles).alias("_content"), F.col(FILE).alias("_surplus_file"), F.col(ROW).alias("_surplus_row")), "trip_keys")
    repeated = narrow.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    rivals = narrow.join(repeated, "_hash", "left_semi")
    order = [F.col(c).desc_nulls_last() for c in (*amounts, "_content", "_surplus_file", "_surplus_row")]
    best = top_n_per_group(rivals, keys, order, 1).select("_surplus_file", "_surplus_row")
    return rivals.select("_surplus_file", "_surplus_row").join(best, ["_surplus_file", "_surplus_row"], "left_anti")


def tag_rejects(
    df: DataFrame, zones: DataFrame, roles: TripRoles, dedup_after_rejects: bool = False
) -> DataFrame:
    """Add ``_reject_reason``; ``df`` carries its row position (``with_position``).

    By contract a kept duplicate may itself fall to an earlier rule while its copies
    still count as duplicates; ``dedup_after_rejects`` ranks surviving rows only.
    """
    business = df.columns
    rules = [incomplete_reason(roles.required), timeliness_reason(roles), datetime_reason(roles)]
    flagged, flags = df, []
    for location, flag in ((roles.pu, "_known_pu"), (roles.do, "_known_do")):
        if location is not None:
            flagged = flag_known_zone(flagged, zones, location, flag)
            flags.append(flag)
            rules.append(F.when(
                F.col(location).isNotNull() & F.col(flag).isNull(),
                F.lit(f"integrity_invalid_{location}"),
            ))
    rules = [r for r in rules if r is not None]
    row_reason = F.coalesce(*rules) if rules else F.lit(None).cast("string")
    flagged = flagged.withColumn(REASON, row_reason).drop(*flags)
    if not roles.keys:
        return flagged

    contender = F.col(REASON).isNull() if dedup_after_rejects else F.lit(True)
    # buckets of all rows, not of contenders alone: rejected rows are dealt beside them, and counting reads the columns of the key only
    marked = _mark_surplus(flagged, roles, contender, hot_buckets(df, roles))
    return marked.select(*business, F.coalesce(F.col(REASON), F.when(F.col("_surplus"), F.lit("uniqueness_duplicate"))).alias(REASON))


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    clean = tagged.filter(F.col(REASON).isNull()).drop(REASON, FILE, ROW)
    return normalize_types(clean), tagged.filter(F.col(REASON).isNotNull()).drop(FILE, ROW)


def clean_split(df, zones, roles, dedup_after_rejects=False) -> tuple[DataFrame, DataFrame]:
    return split(tag_rejects(df, zones, roles, dedup_after_rejects))


def conservation(tagged: DataFrame, scope) -> DataFrame:
    """Per file: source rows = clean rows + rejected rows."""
    return (
        tagged.groupBy(*scope)
        .agg(
            F.count(F.lit(1)).alias("bronce"),
            count_where(F.col(REASON).isNull()).alias("limpios"),
            count_where(F.col(REASON).isNotNull()).alias("rechazados"),
        )
        .withColumn("cuadra", F.col("bronce") == F.col("limpios") + F.col("rechazados"))
    )


def only(roles: TripRoles, *parts: str) -> TripRoles:
    """Roles with every rule switched off except the named ones."""
    off = {"required": (), "keys": (), "dropoff": None, "pu": None, "do": None, "file_year": None}
    kept = {"incomplete": ("required",), "uniqueness": ("keys",), "datetime": ("dropoff",),
            "integrity": ("pu", "do"), "timeliness": ("file_year",)}
    for part in parts:
        for name in kept[part]:
            off.pop(name)
    return replace(roles, **off)
