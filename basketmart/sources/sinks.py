"""Writers: materialised tables and deterministic CSV exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _paths(spark: SparkSession, *names: str) -> list:
    return [spark._jvm.org.apache.hadoop.fs.Path(name) for name in names]


def recover(spark: SparkSession, path: str) -> bool:
    """Put a table back that a stopped replacement had moved aside; whether there was one to put back."""
    table, old = _paths(spark, path.rstrip("/"), f"{path.rstrip('/')}._replaced")
    system = table.getFileSystem(spark._jsc.hadoopConfiguration())
    return not system.exists(table) and system.exists(old) and system.rename(old, table)


def _swapped_in(spark: SparkSession, new: str, path: str) -> None:
    """Let the written folder take the table's place by two renames; the old rows go only after that."""
    fresh, table, old = _paths(spark, new, path.rstrip("/"), f"{path.rstrip('/')}._replaced")
    system = table.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(old, True)
    if system.exists(table) and not system.rename(table, old):
        raise OSError(f"{path} could not be moved aside")
    if not system.rename(fresh, table):
        system.rename(old, table)
        raise OSError(f"{path} could not be replaced")
    system.delete(old, True)


def materialize(
    frame: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "overwrite"
) -> DataFrame:
    """Write a table as parquet, replacing or appending, and return it as read from storage.

    With ``partition_by`` rows are first brought together by those columns, so each partition folder gets a few large
    files; the rebalance splits a folder that holds far more rows than the others.

    A replacement is written beside the table and takes its place by renames once it is whole, so a failed write leaves the
    old rows, and a plan may read the table it replaces. What a stop between the renames leaves, ``recover`` mends, as does
    the next replacement.
    """
    spark = frame.sparkSession
    if mode == "overwrite":
        recover(spark, path)
    columns = list(partition_by)
    if columns:
        frame = frame.hint("rebalance", *columns)
    target = f"{path.rstrip('/')}._{uuid.uuid4().hex}" if mode == "overwrite" else path
    writer = frame.write.mode(mode)
    try:
        (writer.partitionBy(*columns) if columns else writer).parquet(target)
    except Exception:
        if target != path:
            (unfinished,) = _paths(spark, target)
            unfinished.getFileSystem(spark._jsc.hadoopConfiguration()).delete(unfinished, True)
        raise
    if target != path:
        _swapped_in(spark, target, path)
    return spark.read.schema(frame.schema).parquet(path)


def materialize_bucketed(
    frame: DataFrame, table: str, buckets: int, keys: Iterable[str], mode: str = "overwrite"
) -> DataFrame:
    """Save a catalog table bucketed by its join keys, so later joins and aggregations on them need no shuffle."""
    columns = list(keys)
    frame.write.mode(mode).bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(table)
    return frame.sparkSession.table(table)


def append_rows(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows of both frames, matched by column name."""
    return base.unionByName(extra)


def export_csv(frame: DataFrame, path: str, order_by: Iterable[str] | None = None) -> int:
    """Write a headered CSV folder sorted by all columns (missing values last) and return the number of rows.

    The sort is a range partitioning, so parts follow each other in file-name order. Rows are counted on their way to
    the files, behind the sort: ahead of it the sampling of the sort would count them as well.
    """
    order = [F.col(name).asc_nulls_last() for name in (order_by or frame.columns)]
    seen = Observation()
    counted = frame.orderBy(*order).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", True).csv(path)
    return seen.get["rows"]


def export_tables(spark: SparkSession, tables: Mapping[str, DataFrame], names: Iterable[str], folder: str) -> DataFrame:
    """Export the named tables below a folder; returns table names and row counts."""
    counts = [(name, export_csv(tables[name], f"{folder.rstrip('/')}/{name}")) for name in names]
    return spark.createDataFrame(counts, "table string, rows long")


def export_features(features: DataFrame, folder: str) -> int:
    """The feature table ordered by household, ready for a scoring job."""
    return export_csv(features, f"{folder.rstrip('/')}/feature_ready_households", ["household_key"])


def first_rows(frame: DataFrame, k: int) -> list[dict]:
    """``k`` rows, as dictionaries with lower-case names."""
    return [row.asDict() for row in frame.toDF(*[name.lower() for name in frame.columns]).limit(k).collect()]
