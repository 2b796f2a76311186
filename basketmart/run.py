"""Run everything: ``python -m basketmart.run SOURCE_FOLDER OUTPUT_FOLDER [--parquet]``.

Reads the eight CSV sources (or, with ``--parquet``, the star-schema tables), writes the staged tables and the shared
marts as parquet and exports every table as sorted CSV.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from basketmart.plans.kpi_contract import kpi_contract
from basketmart.plans.staging import stage_all
from basketmart.plans.statistics import experiment_mde
from basketmart.plans.warehouse import EXPORTED, marts
from basketmart.session import tune
from basketmart.sources.csv import csv_sources
from basketmart.sources.sinks import export_csv, export_features, export_tables, materialize
from basketmart.sources.star import star_sources


# The two large tables are cut by week, the column time windows filter on.
PARTITIONED_BY = {"transactions": ["week_no"], "merchandising": ["week_no"]}


def run(spark: SparkSession, source: str, output: str, parquet: bool = False) -> DataFrame:
    """Build and export all tables; returns their names and row counts."""
    tune(spark)
    output = output.rstrip("/")
    views = stage_all(star_sources(spark, source) if parquet else csv_sources(spark, source))
    staged = {
        name: materialize(frame, f"{output}/staged/{name}", PARTITIONED_BY.get(name, ())) for name, frame in views.items()
    }

    def keep(name: str, frame: DataFrame) -> DataFrame:
        return materialize(frame, f"{output}/marts/{name}")

    tables = marts(staged, keep)
    counts = export_tables(spark, tables, EXPORTED, f"{output}/tables")
    export_features(tables["mart_customer_features"], f"{output}/tables")
    export_csv(experiment_mde(tables["mart_household_period"]), f"{output}/tables/experiment_mde")
    export_csv(kpi_contract(spark), f"{output}/tables/kpi_contract", ["kpi"])
    return counts


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--parquet", action="store_true", help="source is a folder of star-schema parquet files")
    options = parser.parse_args()
    session = SparkSession.builder.appName("basketmart").getOrCreate()
    run(session, options.source, options.output, options.parquet).show(truncate=False)
    session.stop()
