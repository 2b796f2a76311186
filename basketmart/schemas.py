"""Declared schemas of the eight source tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns.items()])


DEMOGRAPHIC_COLUMNS = [
    "age_desc",
    "marital_status_code",
    "income_desc",
    "homeowner_desc",
    "hh_comp_desc",
    "household_size_desc",
    "kid_category_desc",
]

SCHEMAS: dict[str, T.StructType] = {
    "transaction_data": _schema(
        household_key="long",
        basket_id="long",
        day="int",
        week_no="int",
        product_id="long",
        quantity="double",
        sales_value="double",
        store_id="long",
        retail_disc="double",
        coupon_disc="double",
        coupon_match_disc="double",
        trans_time="string",
    ),
    "product": _schema(
        product_id="long",
        manufacturer="long",
        brand="string",
        curr_size_of_product="string",
        department="string",
        commodity_desc="string",
        sub_commodity_desc="string",
    ),
    "hh_demographic": _schema(household_key="long", **{name: "string" for name in DEMOGRAPHIC_COLUMNS}),
    "campaign_desc": _schema(campaign="int", description="string", start_day="int", end_day="int"),
    "campaign_table": _schema(household_key="long", campaign="int"),
    "coupon": _schema(coupon_upc="long", product_id="long", campaign="int"),
    "coupon_redempt": _schema(household_key="long", day="int", coupon_upc="long", campaign="int"),
    "causal_data": _schema(product_id="long", store_id="long", week_no="int", display="string", mailer="string"),
}

# The merchandising feed may be absent; every other table is required.
OPTIONAL_SOURCES = {"causal_data"}

# Columns a source may lack without being rejected.
OPTIONAL_COLUMNS = {"hh_demographic": set(DEMOGRAPHIC_COLUMNS)}

# The file names a source may be delivered under, tried in this order.
FILE_NAMES: dict[str, list[str]] = {
    "transaction_data": ["transaction_data.csv", "_transactiondata.csv", "transactiondata.csv"],
    "product": ["product.csv", "_product.csv"],
    "hh_demographic": ["hh_demographic.csv", "_hhdemographic.csv", "hhdemographic.csv"],
    "campaign_desc": ["campaign_desc.csv", "_campaigndesc.csv", "campaigndesc.csv"],
    "campaign_table": ["campaign_table.csv", "_campaigntable.csv", "campaigntable.csv"],
    "coupon": ["coupon.csv", "_coupon.csv"],
    "coupon_redempt": ["coupon_redempt.csv", "_couponredempt.csv", "couponredempt.csv"],
    "causal_data": ["causal_data.csv", "_causaldata.csv", "causaldata.csv"],
}
