"""Session settings the plans rely on, and the shared folder for intermediate tables.

Only run-time SQL settings are touched, so a session started by a scheduler or a notebook can be passed in as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Skewed sort-merge joins are split even where that costs one more shuffle: a key holding a third of the rows would
# otherwise be joined, and aggregated, by a single task.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Upper limits, in bytes. Sorted keys and flags shuffle at a few bytes a row, so by Spark's own limits a merged task holds
# many millions of rows, and the more the larger the tables are: its aggregation or sort then spills.
MOST_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 4 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}


def tune(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution with forced skew splitting, lower the sizes of merged tasks and file splits to
    ``MOST_BYTES`` where they are larger; leave every other setting alone."""
    for key, value in ADAPTIVE_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in MOST_BYTES.items():
        held = spark.conf.get(key, None)
        if held is None or in_bytes(held) > most:
            spark.conf.set(key, str(most))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; where it is unset, a folder below the warehouse, which executors share as well."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/basketmart-{uuid.uuid4().hex}"


# Shuffle files go when the execution that made them ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and read it back.

    Cuts the lineage for a result used several times. Unlike a cached frame it survives the loss of an executor, and
    unlike a row checkpoint it is columnar: later plans read only the columns they need and know the table's size.
    Nothing reads the shuffles of the write afterwards, so their files are freed with its end.
    """
    spark = frame.sparkSession
    path, held = scratch_path(spark), spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        if held is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, held)
    return spark.read.schema(frame.schema).parquet(path)
