"""Compare registered queries with their SQL: ``python tests/run_compare.py [sf] [name ...]``."""

import sys
import time

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

from compare import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
wanted = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "12g")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
folder = f"/root/testdata/sf{sf}"
con = connect(folder)
oracles = oracle_sql()
failed = 0
for name, build in queries().items():
    if wanted and name not in wanted:
        continue
    start = time.time()
    try:
        if name in oracles:
            problems = differences(build(spark, folder), con, oracles[name])
        else:
            problems = [] if build(spark, folder).count() else ["no rows"]
    except Exception as error:  # noqa: BLE001
        problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
    failed += bool(problems)
    print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s{'' if name in oracles else ' (rows only)'}")
    for problem in problems:
        print("   ", problem)
print("failed:", failed)
