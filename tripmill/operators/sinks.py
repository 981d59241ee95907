"""Writing the lake, registering it in the catalog, publishing models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schema import PARTITION_COLUMNS, TRIP_TYPES, ddl
from tripmill.session import conf_set

# Fixed write options of the lake. Dictionary encoding is left on unless asked for:
# without it, low-cardinality columns cost several times the bytes to scan.
PARQUET_OPTIONS = {"compression": "snappy", "parquet.writer.version": "v1"}


def lay_out(df: DataFrame, layout: str, keys: Sequence[str], num_files: int | None = None) -> DataFrame:
    """Distribute rows for a partitioned write.

    ``balanced``  one shuffle by key; AQE cuts a hot day into several tasks and merges
                  small ones, so file sizes stay even.
    ``none``      no shuffle: every task writes a file into every partition it meets.
    ``hash``      a fixed number of key-hashed tasks; one key stays in one task, so this
                  is for inputs known to be even.
    """
    if layout == "balanced":
        return df.hint("rebalance", *keys)
    if layout == "none":
        return df
    if layout == "hash":
        return df.repartition(num_files or 10, *keys)
    raise ValueError(f"unknown layout: {layout}")


def write_lake(
    df: DataFrame,
    path: str,
    mode: str = "overwrite_partitions",
    layout: str = "balanced",
    num_files: int | None = None,
    partitions: Sequence[str] = PARTITION_COLUMNS,
    dictionary: bool = True,
) -> None:
    """Write Parquet partitions.

    ``overwrite_partitions`` replaces just the partitions present in ``df``, so a repeated
    run is harmless; ``append`` adds to them and doubles rows when repeated.
    """
    if mode not in ("overwrite_partitions", "append"):
        raise ValueError(f"unknown mode: {mode}")
    writer = lay_out(df, layout, partitions, num_files).write.options(**PARQUET_OPTIONS)
    if not dictionary:
        writer = writer.option("parquet.enable.dictionary", "false")
    if mode == "append":
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    # Opening a file costs more than starting a task, so let AQE keep small tasks apart.
    with conf_set(df.sparkSession, spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB"):
        writer.partitionBy(*partitions).parquet(path)


def create_lake_table(spark: SparkSession, table: str, path: str) -> None:
    """External partitioned table over a lake folder."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl(TRIP_TYPES)}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{path}'"
    )


def register_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Make partitions found in storage known to the catalog; returns those it knows now."""
    spark.catalog.recoverPartitions(table)
    return spark.sql(f"SHOW PARTITIONS {table}")


def insert_lake(df: DataFrame, table: str, mode: str = "overwrite_partitions", layout: str = "balanced", num_files: int | None = None) -> None:
    """Write into a table made by ``create_lake_table``.

    The write's own commit tells the catalog which partitions it touched, so nothing is listed
    and ``register_partitions`` is left for folders that something else filled.
    """
    if mode not in ("overwrite_partitions", "append"):
        raise ValueError(f"unknown mode: {mode}")
    spark = df.sparkSession
    columns = spark.table(table).columns
    rows = lay_out(df.select(*columns), layout, PARTITION_COLUMNS, num_files)
    with conf_set(
        spark,
        spark__sql__sources__partitionOverwriteMode="dynamic",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    ):
        rows.write.insertInto(table, overwrite=mode == "overwrite_partitions")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def table_summary(spark: SparkSession, table: str) -> DataFrame:
    """One row: the table's kind and how many partitions the catalog knows."""
    kind = describe_table(spark, table).where("col_name = 'Type'").select(F.col("data_type").alias("kind"))
    known = spark.sql(f"SHOW PARTITIONS {table}").agg(F.count("*"))
    return kind.select("kind", known.scalar().alias("n_partitions"))


def publish(models: dict[str, DataFrame | Callable[[], DataFrame]], layer: str, as_table: bool = False) -> list[str]:
    """Publish models as ``{layer}_{name}``: views by default, tables when several readers share them."""
    names = []
    for name, model in models.items():
        df = model() if callable(model) else model
        target = f"{layer}_{name}"
        if as_table:
            df.write.mode("overwrite").saveAsTable(target)
            df.sparkSession.catalog.dropTempView(target)  # it would hide the table
        else:
            df.createOrReplaceTempView(target)
        names.append(target)
    return names


def read_mart(spark: SparkSession, name: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """A published model by name."""
    return spark.table(name).select(*columns)
