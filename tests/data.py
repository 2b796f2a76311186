"""Small hand-made source rows."""

from basketmart.plans.staging import stage_all
from basketmart.schemas import SCHEMAS

LINE_DEFAULTS = {
    "household_key": 1,
    "basket_id": 1,
    "day": 1,
    "week_no": 1,
    "product_id": 1,
    "quantity": 1.0,
    "sales_value": 1.0,
    "store_id": 1,
    "retail_disc": 0.0,
    "coupon_disc": None,
    "coupon_match_disc": None,
    "trans_time": "0930",
}


def lines(spark, *rows):
    """Raw receipt lines; each row overrides the defaults."""
    names = SCHEMAS["transaction_data"].names
    full = [tuple({**LINE_DEFAULTS, **row}[name] for name in names) for row in rows]
    return spark.createDataFrame(full, SCHEMAS["transaction_data"])


def table(spark, name, *rows):
    return spark.createDataFrame([tuple(row) for row in rows], SCHEMAS[name])


def staged(spark, transactions, **tables):
    """Staged tables, empty where not given."""
    sources = {name: table(spark, name) for name in SCHEMAS}
    sources["transaction_data"] = lines(spark, *transactions)
    for name, rows in tables.items():
        sources[name] = table(spark, name, *rows)
    return stage_all(sources)


def dicts(frame, *order):
    rows = [row.asDict() for row in frame.collect()]
    return sorted(rows, key=lambda row: tuple((row[k] is not None, row[k]) for k in order)) if order else rows
