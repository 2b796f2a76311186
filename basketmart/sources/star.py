"""Adapter: the eight source tables derived from a star schema of parquet files.

``part``, ``customer``, ``orders``, ``lineitem`` and ``nation`` become products, demographics, receipts and campaigns.
Conditions between two tables are written as equalities of expressions, so they plan as hash joins.
"""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketmart.sources.tables import LazyTables


@lru_cache(maxsize=256)
def _schema_of(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def _read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    path = f"{folder}/{table}.parquet"
    return spark.read.schema(_schema_of(spark, path)).parquet(path).select(*columns)


def _spread(frame: DataFrame) -> DataFrame:
    """Give a scan of few tasks as many as there are cores.

    A table of one or two files would keep the rest of the plan on one core. Tables that already fill the cluster,
    i.e. all that matter at scale, are returned unchanged and not shuffled.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    elapsed = "datediff(cast(o_orderdate as date), DATE '1995-01-01')"
    return _read(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        F.col("o_orderkey"),
        F.col("o_custkey").alias("household_key"),
        F.expr(f"cast({elapsed} * 711 div 2405 + 1 as int)").alias("day"),
        F.expr(f"cast(({elapsed} * 711 div 2405) div 7 + 1 as int)").alias("week_no"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = _read(
        spark,
        folder,
        "lineitem",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_returnflag",
        "l_linestatus",
    )
    return _spread(lineitem).join(_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))


def transaction_data(spark: SparkSession, folder: str) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    cents = F.when((key * 3 + line) % 991 == 0, F.lit(0).cast("long")).otherwise(
        F.round(F.col("l_extendedprice") * 100).cast("long")
    )
    priced = _lines(spark, folder).withColumn("ext", cents)
    priced = priced.withColumns(
        {
            "retail": F.expr("ext * cast(round(l_discount * 100) as bigint) div 100"),
            "coupon": F.expr("case when (l_orderkey + l_linenumber) % 17 = 0 then ext * 5 div 100 end"),
            "matched": F.expr("case when (l_orderkey + l_linenumber) % 34 = 0 then ext * 2 div 100 end"),
        }
    )
    net = F.col("ext") - F.col("retail") - F.coalesce("coupon", F.lit(0)) - F.coalesce("matched", F.lit(0))
    clock = (
        F.when((key + line) % 503 == 0, "abc")
        .when((key + line) % 501 == 0, "2575")
        .otherwise(((key % 24) * 100 + key % 60).cast("string"))
    )
    return priced.select(
        "household_key",
        key.alias("basket_id"),
        "day",
        "week_no",
        F.col("l_partkey").alias("product_id"),
        F.when((key * 7 + line) % 997 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("quantity"),
        (net / 100.0).alias("sales_value"),
        F.col("l_suppkey").alias("store_id"),
        (-F.col("retail") / 100.0).alias("retail_disc"),
        (-F.col("coupon") / 100.0).alias("coupon_disc"),
        (-F.col("matched") / 100.0).alias("coupon_match_disc"),
        clock.alias("trans_time"),
    )


def product(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    part = _read(spark, folder, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").filter(key % 211 != 0)
    commodity = (
        F.when(key % 97 == 0, None)
        .when(key % 89 == 0, "  ")
        .when(key % 83 == 0, F.lower("p_brand"))
        .otherwise(F.col("p_brand"))
    )
    return part.select(
        key.alias("product_id"),
        (key % 100).alias("manufacturer"),
        F.when(F.col("p_size") % 4 == 0, "Private").otherwise("National").alias("brand"),
        F.concat(F.col("p_size").cast("string"), F.lit(" OZ")).alias("curr_size_of_product"),
        F.when(key % 97 != 0, F.col("p_type")).alias("department"),
        commodity.alias("commodity_desc"),
        F.col("p_name").alias("sub_commodity_desc"),
    )


def hh_demographic(spark: SparkSession, folder: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    customer = _read(spark, folder, "customer", "c_custkey", "c_acctbal", "c_mktsegment").filter(key % 3 == 0)
    age = F.when(balance < 0, "19-24").when(balance < 3000, "25-34").when(balance < 6000, "45-54").otherwise("65+")
    return customer.select(
        key.alias("household_key"),
        age.alias("age_desc"),
        F.when(key % 2 == 0, "A").otherwise("U").alias("marital_status_code"),
        F.col("c_mktsegment").alias("income_desc"),
        F.when(key % 5 != 0, "Homeowner").alias("homeowner_desc"),
        F.when(key % 4 == 0, "Single").otherwise("2 Adults Kids").alias("hh_comp_desc"),
        F.when(key % 7 == 0, "5+").otherwise("2").alias("household_size_desc"),
        F.when(key % 9 == 0, "3+").otherwise("None/Unknown").alias("kid_category_desc"),
    )


def campaign_desc(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_nationkey")
    return _read(spark, folder, "nation", "n_nationkey").select(
        n.cast("int").alias("campaign"),
        F.expr("concat('Type', substr('ABC', cast(n_nationkey % 3 as int) + 1, 1))").alias("description"),
        (n * 26 + 30).cast("int").alias("start_day"),
        (n * 26 + 62 + (n % 4) * 7).cast("int").alias("end_day"),
    )


def campaign_table(spark: SparkSession, folder: str) -> DataFrame:
    customer = _read(spark, folder, "customer", "c_custkey")
    nation = _read(spark, folder, "nation", "n_nationkey")
    # (7c + 3n) divisible by 11, written as an equality between one expression of each table
    divisible = (F.col("n_nationkey") * 3) % 11 == F.expr("pmod(-7 * c_custkey, 11)")
    return customer.join(nation, divisible).select(
        F.col("c_custkey").alias("household_key"), F.col("n_nationkey").cast("int").alias("campaign")
    )


def coupon(spark: SparkSession, folder: str) -> DataFrame:
    part = _read(spark, folder, "part", "p_partkey")
    nation = _read(spark, folder, "nation", "n_nationkey")
    matched = part.join(nation, F.col("n_nationkey") % 39 == F.expr("pmod(-p_partkey, 39)"))
    copies = F.when((F.col("p_partkey") + F.col("n_nationkey")) % 78 == 0, 2).otherwise(1)
    return matched.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(
        (F.lit(1000) + F.col("n_nationkey") * 10 + F.col("p_partkey") % 5).alias("coupon_upc"),
        F.col("p_partkey").alias("product_id"),
        F.col("n_nationkey").cast("int").alias("campaign"),
    )


def coupon_redempt(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = _read(spark, folder, "lineitem", "l_orderkey")
    visits = (
        _orders(spark, folder)
        .filter(F.col("o_orderkey") % 2 == 0)
        .join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    )
    exposed = campaign_table(spark, folder).join(campaign_desc(spark, folder), "campaign")
    hits = exposed.join(visits, "household_key").filter(F.col("day").between(F.col("start_day"), F.col("end_day")))
    return hits.select(
        "household_key",
        "day",
        (F.lit(1000) + F.col("campaign") * 10 + F.col("o_orderkey") % 5).alias("coupon_upc"),
        "campaign",
    ).distinct()


def causal_data(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).filter(F.col("l_partkey") % 3 != 0)
    copies = F.when(F.col("week_no") % 10 == 0, 2).otherwise(1)
    display = F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") != "A", "0")
    mailer = F.when((F.col("l_linestatus") == "O") & (F.col("l_partkey") % 5 == 0), "A").otherwise("0")
    return lines.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        "week_no",
        display.alias("display"),
        mailer.alias("mailer"),
    )


SOURCES = [
    transaction_data,
    product,
    hh_demographic,
    campaign_desc,
    campaign_table,
    coupon,
    coupon_redempt,
    causal_data,
]


def fingerprint(spark: SparkSession, folder: str, *tables: str) -> tuple:
    """Length and modification time of some tables' files: changes when they do."""
    marks = []
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        summary = system.getContentSummary(path)
        marks.append((table, summary.getLength(), summary.getFileCount(), system.getFileStatus(path).getModificationTime()))
    return tuple(marks)


def star_sources(spark: SparkSession, folder: str) -> LazyTables:
    """All eight source tables of one parquet folder; each is planned when it is first asked for."""
    return LazyTables({build.__name__: partial(build, spark, folder) for build in SOURCES})
