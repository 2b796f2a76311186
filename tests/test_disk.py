import time
from collections import Counter

from pyspark.sql import functions as F

from basketmart.plans.validation import _Measures, repeated_rows
from basketmart.session import FREE_SHUFFLES, stored


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle")}


def left_over(spark, work):
    """Shuffle files of some work that are still there a while after it; freeing is asynchronous."""
    held, result = shuffle_files(spark), work()
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - held) and time.monotonic() < until:
        time.sleep(0.2)
    return result, left


def test_a_stored_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(FREE_SHUFFLES, None)
    counts = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).count()
    table, left = left_over(spark, lambda: stored(counts))
    assert not left and table.count() == 1000
    assert spark.conf.get(FREE_SHUFFLES, None) == setting


def test_settled_measures_leave_no_shuffle_files_and_keep_their_values(spark):
    def work():
        m = _Measures()
        m.add(spark.range(5000).groupBy((F.col("id") % 70).alias("k")).count(), groups=F.count("k"))
        m.settle()
        m.add(spark.range(9), rows=F.count(F.lit(1)), nothing=F.max(F.lit(None).cast("int")))
        m.settle()
        return m

    m, left = left_over(spark, work)
    assert not left and m.wide().collect() == [(70.0, 9.0, 0.0)]


def test_repeated_rows_are_those_equal_in_every_column(spark):
    rows = [(1, None, 2.5, "x"), (None, 1, 2.5, "x"), (1, None, 2.5, "x"), (2, 2, 0.0, None), (2, 2, -0.0, None), (3, 3, 1.0, "y")]
    rows += [(4, 4, float("nan"), "z")] * 3 + [(None, None, None, None)] * 2 + [(5, k, 1.0, "y") for k in range(50)]
    frame = spark.createDataFrame(rows, "a long, b long, c double, d string")
    got = {(r.a, r.b, r.d): r.n for r in repeated_rows(frame, frame.columns).collect()}
    assert got == {(1, None, "x"): 2, (2, 2, None): 2, (4, 4, "z"): 3, (None, None, None): 2}
    # a column that is left out of the comparison
    wanted = Counter((a, d) for a, _, _, d in rows)
    assert {(r.a, r.d): r.n for r in repeated_rows(frame, ["a", "d"]).collect()} == {k: n for k, n in wanted.items() if n > 1}
    assert repeated_rows(frame.limit(0), frame.columns).count() == 0
