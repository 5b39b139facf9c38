"""Parquet or JSON tables whose partitions are replaced as a whole."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, remove_path, scratch_path

BROADCAST_ROWS = 200_000
CODEC = "zstd"  # of stored Parquet partitions: text takes about half the room it takes with Spark's default


def partition_path(spark: SparkSession, root: str, **values: str) -> str:
    """Directory of one partition, named the way Spark names it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([root.rstrip("/")] + [f"{k}={escape(v)}" for k, v in values.items()])


def replace_partitions(
    rows: DataFrame,
    path: str,
    by: Iterable[str],
    emptied: DataFrame | None = None,
    fmt: str = "parquet",
) -> None:
    """Overwrite exactly the partitions found in ``rows``.

    Spark's dynamic overwrite leaves partitions alone that get no new row, so
    those named in ``emptied`` (all columns of ``by``) are removed one by one.
    Both steps can be repeated after a failure.
    """
    by = list(by)
    spark = rows.sparkSession
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    writer.partitionBy(*by).format(fmt).save(path)
    if emptied is not None:
        for row in emptied.select(*by).distinct().toLocalIterator():
            target = partition_path(spark, path, **{c: row[c] for c in by})
            if path_exists(spark, target):
                remove_path(spark, target)


def read_partitions(
    spark: SparkSession, root: str, schema: T.StructType, parts: Iterable[dict[str, str]]
) -> DataFrame:
    """Only the named partitions: neither listed nor read beyond them."""
    paths = [partition_path(spark, root, **p) for p in parts]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def stored_side(keys: DataFrame) -> DataFrame:
    """Keys that take part in a join, stored once and broadcast if counted small."""
    spark = keys.sparkSession
    path = scratch_path(spark, "keys")
    keys.write.parquet(path)
    return small_side(spark.read.schema(keys.schema).parquet(path), len(keys.columns))


def small_side(df: DataFrame, columns: int = 3) -> DataFrame:
    """Ask for a broadcast if the stored table ``df`` is counted small, else
    leave the join to Spark."""
    return F.broadcast(df) if df.count() * columns <= BROADCAST_ROWS * 3 else df
