"""Data checks: one row per check with its number of failures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StringType

from tripmill.functions.times import as_of_column
from tripmill.operators.load import in_partitions_of, read_if_exists
from tripmill.operators.sinks import write_lake


@dataclass(frozen=True)
class NotNull:
    column: str

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    """Values outside the list fail; NULL passes."""

    column: str
    values: tuple

    def failing(self) -> Column:
        return F.coalesce(~F.col(self.column).isin(list(self.values)), F.lit(False))


@dataclass(frozen=True)
class Unique:
    """Failures are the non-NULL values that occur more than once."""

    column: str


@dataclass(frozen=True)
class Relationship:
    """Failures are rows whose non-NULL value is not in the parent column."""

    column: str
    parent: DataFrame
    parent_column: str


NAMES = {
    NotNull: "not_null",
    Accepted: "accepted_values",
    Unique: "unique",
    Relationship: "relationships",
}


def _counted(df: DataFrame, checks: Sequence, failures: Sequence[Column]) -> DataFrame:
    """One aggregate over ``df``, a figure per check, turned into one row per check."""
    wide = df.agg(*[f.cast("bigint").alias(f"c{i}") for i, f in enumerate(failures)])
    rows = [
        F.struct(
            F.lit(NAMES[type(c)]).alias("check"), F.lit(c.column).alias("column"), F.col(f"c{i}").alias("failures")
        )
        for i, c in enumerate(checks)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _as_type(df: DataFrame, column: str, kind) -> Column:
    """A value in another type; NULL if it does not fit, or if the cast would cut a fraction off."""
    value = F.col(column).try_cast(kind)
    if isinstance(df.schema[column].dataType, FractionalType) and not isinstance(kind, FractionalType | StringType):
        return F.when(value.isNotNull() & (F.col(column) == value), value)
    return value


def _value_counts(df: DataFrame, columns: Sequence[str], kind) -> DataFrame:
    """Rows per column and non-NULL value, for several columns in one scan.

    A frequent value reaches the shuffle as one row per task. Values that do not fit the type
    count together as a NULL value.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), _as_type(df, c, kind).alias("value"), F.col(c).isNotNull().alias("given"))
        for c in columns
    ]
    values = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
    return values.where("given").groupBy("column", "value").agg(F.count("*").alias("n"))


def _unique(df: DataFrame, checks: Sequence[Unique], kind) -> DataFrame:
    counts = _value_counts(df, [c.column for c in checks], kind)
    return _counted(counts, checks, [F.count_if((F.col("column") == c.column) & (F.col("n") > 1)) for c in checks])


def _relationships(df: DataFrame, checks: Sequence[Relationship]) -> DataFrame:
    """Checks against one parent column."""
    parent = checks[0].parent.select(F.col(checks[0].parent_column).alias("value")).distinct()
    counts = _value_counts(df, [c.column for c in checks], parent.schema["value"].dataType)
    orphans = counts.join(parent, "value", "left_anti")
    rows_of = [F.sum(F.when(F.col("column") == c.column, F.col("n"))) for c in checks]
    return _counted(orphans, checks, [F.coalesce(n, F.lit(0)) for n in rows_of])


def run_checks(df: DataFrame, checks: Sequence) -> DataFrame:
    """``(check, column, failures)``.

    Null and accepted-value checks share one scan, unique checks one per column type, and
    relationships one per parent.
    """
    frames = []
    row_level = [c for c in checks if isinstance(c, NotNull | Accepted)]
    if row_level:
        frames.append(_counted(df, row_level, [F.count_if(c.failing()) for c in row_level]))
    by_type: dict = {}
    by_parent: dict = {}
    for check in checks:
        if isinstance(check, Unique):
            by_type.setdefault(df.schema[check.column].dataType, []).append(check)
        elif isinstance(check, Relationship):
            by_parent.setdefault((id(check.parent), check.parent_column), []).append(check)
    frames += [_unique(df, group, kind) for kind, group in by_type.items()]
    frames += [_relationships(df, group) for group in by_parent.values()]
    return reduce(DataFrame.unionByName, frames)


# --- checks kept by partition ---------------------------------------------------
STATE = ("check", "column", "value", "n")


def check_states(df: DataFrame, checks: Sequence, partitions: Sequence[str]) -> DataFrame:
    """What each partition adds to the checks: ``partitions, check, column, value, n``.

    Null and accepted-value checks add their failures, unique and relationship checks the
    number of rows of each value, as text in the type it is compared in. A row without a check
    stands for the partition itself and its rows, so a partition without rows is known too.
    """
    keys = list(partitions)

    def named(check, value: Column) -> list[Column]:
        return [F.lit(NAMES[type(check)]).alias("check"), F.lit(check.column).alias("column"), value.cast("string").alias("value")]

    row_level = [c for c in checks if isinstance(c, NotNull | Accepted)]
    sums = df.groupBy(*keys).agg(F.count("*").alias("rows"), *[F.count_if(c.failing()).alias(f"c{i}") for i, c in enumerate(row_level)])
    none = F.lit(None).cast("string")
    figures = [F.struct(none.alias("check"), none.alias("column"), none.alias("value"), F.col("rows").alias("n"))]
    figures += [F.struct(*named(c, none), F.col(f"c{i}").alias("n")) for i, c in enumerate(row_level)]
    states = sums.select(*keys, F.inline(F.array(*figures)))
    by_value = []
    for check in checks:
        if isinstance(check, Unique):
            by_value.append(F.struct(*named(check, F.col(check.column)), F.col(check.column).isNotNull().alias("given")))
        elif isinstance(check, Relationship):
            kind = check.parent.schema[check.parent_column].dataType
            by_value.append(F.struct(*named(check, _as_type(df, check.column, kind)), F.col(check.column).isNotNull().alias("given")))
    if by_value:
        values = df.select(*keys, F.inline(F.array(*by_value))).where("given")
        states = states.unionByName(values.groupBy(*keys, "check", "column", "value").agg(F.count("*").alias("n")))
    return states


def merged_checks(states: DataFrame, checks: Sequence) -> DataFrame:
    """``run_checks`` over the union of all partitions, from their states alone.

    A value that occurs in several partitions is counted over all of them, so uniqueness and
    the parents as they are now are judged exactly.
    """
    summed = states.groupBy("check", "column", "value").agg(F.sum("n").alias("n"))
    frames = []
    for check in checks:
        mine = summed.where((F.col("check") == NAMES[type(check)]) & (F.col("column") == check.column))
        if isinstance(check, Unique):
            failures = F.count_if(F.col("n") > 1)
        else:
            failures = F.coalesce(F.sum("n"), F.lit(0))
        if isinstance(check, Relationship):
            parent = check.parent.select(F.col(check.parent_column).cast("string").alias("value")).distinct()
            mine = mine.join(parent, "value", "left_anti")
        named = [F.lit(NAMES[type(check)]).alias("check"), F.lit(check.column).alias("column")]
        frames.append(mine.agg(failures.cast("bigint").alias("failures")).select(*named, "failures"))
    return reduce(DataFrame.unionByName, frames)


def refresh_checks(df: DataFrame, checks: Sequence, path: str, partitions: Sequence[str], changed: DataFrame | None = None) -> DataFrame:
    """Bring the states under ``path`` up to date and return the checks' failures.

    Only the ``changed`` partitions of ``df``, a frame of their values, are read; without it
    all are. A changed partition that holds no rows any more replaces what it added before.
    """
    keys = list(partitions)
    if changed is None:
        states = check_states(df, checks, keys)
    else:
        changed = changed.select(*keys).distinct()
        states = check_states(in_partitions_of(changed, df, keys), checks, keys)
        gone = changed.join(states.select(*keys).distinct(), keys, "left_anti")
        none = [F.lit(None).cast("string").alias(c) for c in STATE[:3]]
        states = states.unionByName(gone.select(*keys, *none, F.lit(0).cast("bigint").alias("n")))
    write_lake(states, path, partitions=keys)
    return merged_checks(read_if_exists(df.sparkSession, path), checks)


def freshness(df: DataFrame, column: str = "inserted_at", as_of=None) -> DataFrame:
    """Newest load time and its age."""
    newest = df.agg(F.max(column).alias("newest"))
    now = as_of_column(as_of)
    return newest.select(
        "newest", (F.unix_timestamp(now) - F.unix_timestamp("newest")).alias("age_seconds")
    )


def sanity_share(df: DataFrame, start: str = "pickup_at", end: str = "dropoff_at") -> DataFrame:
    """How many rows the end-not-before-start filter drops."""
    kept = F.count_if(F.col(end) >= F.col(start))
    counted = df.agg(F.count("*").alias("total_rows"), kept.alias("kept_rows"))
    return counted.select(
        "total_rows",
        "kept_rows",
        (F.col("total_rows") - F.col("kept_rows")).alias("dropped_rows"),
        F.round(F.try_divide(F.col("total_rows") - F.col("kept_rows"), F.col("total_rows")), 6).alias("dropped_share"),
    )


# Constraints of the models.
def trip_checks(zones: DataFrame) -> list:
    return [
        NotNull("pickup_at"),
        NotNull("dropoff_at"),
        Accepted("store_and_fwd_flag", ("Y", "N")),
        Relationship("pickup_location_id", zones, "location_id"),
        Relationship("dropoff_location_id", zones, "location_id"),
    ]


def zone_checks() -> list:
    return [NotNull("location_id"), Unique("location_id")]


def stream_checks(zones: DataFrame) -> list:
    return [
        NotNull("trip_id"),
        NotNull("pickup_at"),
        Relationship("pickup_location_id", zones, "location_id"),
        Relationship("dropoff_location_id", zones, "location_id"),
    ]


def busiest_checks() -> list:
    return [
        NotNull("grain"),
        Accepted("grain", ("overall", "by_month")),
        NotNull("pickup_zone"),
        NotNull("total_trips"),
    ]


def enriched_checks() -> list:
    return [NotNull("pickup_at")]


# Columns of the marts that must hold a value.
MART_COLUMNS = {
    "avg_fare_by_zone": ("pickup_zone", "avg_fare"),
    "monthly_cab_counts": ("cab_type", "pickup_month", "trip_count"),
    "avg_passengers_by_cab": ("cab_type", "avg_passenger_count"),
    "avg_duration_by_cab_month": ("cab_type", "pickup_month", "avg_trip_duration_min"),
}


def mart_checks(mart: str) -> list:
    return busiest_checks() if mart == "busiest_zone" else [NotNull(c) for c in MART_COLUMNS[mart]]
