"""URL filter by association rules.

An address is a set of tokens: labels of its host, segments of its path (numbers by their digits), names of query
parameters, scheme and fragment. FP-growth mines token sets together with the verdict item from the labelled addresses.
Sets with a verdict become rules; a rule stays if its confidence is high enough and above that of each rule with one token
less. Rules are indexed by their rarest token: an address looks its tokens up, and the rules found are checked for their
other tokens. A list of written rules, where one fits, comes first.

DataFrame and JVM operations only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import read_table
from basketmart.session import stored

# The written rules (verdict, host, path).
WRITTEN = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
LEAST_SUPPORT = 0.002  # of the labelled addresses
LEAST_CONFIDENCE = 0.6
DEFAULT = "allow"
_VERDICTS = ("=allow", "=block")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host`` and ``path``; both empty for a null address or one without ``://``."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("rest", F.coalesce(rest, F.lit("")))
    rows = rows.withColumn("raw", F.regexp_extract("rest", r"^[^/?#]*", 0))
    rows = rows.withColumn("tail", F.expr("substring(rest, length(raw) + 1)"))
    return rows.select(
        "page_id",
        "url",
        F.translate("raw", _UPPER, _LOWER).alias("host"),
        F.regexp_extract("tail", r"^[^?#]*", 0).alias("path"),
        "tail",
    )


def _written(value) -> Column:
    """``value(verdict, name)`` of the longest written rule that fits, else null."""
    out = F.lit(None).cast("string")
    for verdict, host, path in sorted(WRITTEN, key=lambda rule: (len(rule[1] + rule[2]), rule)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(value(verdict, host + path))).otherwise(out)
    return out


def _tokens() -> Column:
    """Sorted distinct tokens of an address with ``url``, ``host``, ``path`` and ``tail``."""

    def named(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    number = F.regexp_replace(F.translate("path", _UPPER, _LOWER), r"[0-9]", "9")
    question = F.regexp_extract("tail", r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(question, "&"), lambda x: F.regexp_extract(x, r"^[^=]*", 0))
    scheme = F.array(F.lower(F.substring_index(F.coalesce("url", F.lit("")), "://", 1)))
    ends = F.array(F.when(F.instr("tail", "#") > 0, "fragment").otherwise(""))
    known = F.when(F.col("host") != "", named("s:", scheme)).otherwise(F.array().cast("array<string>"))
    return F.array_sort(
        F.array_distinct(
            F.concat(
                known,
                named("h:", F.split("host", r"\.")),
                named("p:", F.split(number, "/")),
                named("q:", keys),
                named("f:", ends),
            )
        )
    )


def described(pages: DataFrame) -> DataFrame:
    rows = parted(pages)
    return rows.select(
        "page_id",
        "host",
        "path",
        _written(lambda verdict, name: name).alias("rule"),
        _written(lambda verdict, name: verdict).alias("ruled"),
        _tokens().alias("tokens"),
    )


def mine_rules(
    labelled: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE
) -> DataFrame:
    """``tokens``, ``verdict``, ``confidence``, ``n`` and ``anchor`` of the rules mined from ``tokens`` and ``verdict``.

    Rows without a verdict or without tokens teach nothing. Repeated rows count each. The number of frequent token sets
    depends on the support, a share, not on the number of rows.
    """
    rows = labelled.filter(F.col("verdict").isin("allow", "block") & (F.size("tokens") > 0))
    baskets = rows.select(F.array_append("tokens", F.concat(F.lit("="), "verdict")).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=1.0).fit(stored(baskets)).freqItemsets
    sets = stored(
        found.select(
            F.array_sort(F.filter("items", lambda x: ~x.isin(*_VERDICTS))).alias("tokens"),
            F.array_max(F.filter("items", lambda x: x.isin(*_VERDICTS))).alias("item"),
            F.size(F.filter("items", lambda x: x.isin(*_VERDICTS))).alias("verdicts"),
            F.col("freq").alias("n"),
        )
    )
    whole = sets.filter("verdicts = 0").select("tokens", F.col("n").alias("all"))
    rules = sets.filter("verdicts = 1 and size(tokens) > 0").join(whole, "tokens")
    rules = stored(
        rules.select("tokens", F.expr("substring(item, 2)").alias("verdict"), "n", (F.col("n") / F.col("all")).alias("confidence"))
    )
    shorter = rules.select("tokens", "verdict", F.explode("tokens").alias("without")).select(
        "tokens", "verdict", F.array_remove("tokens", F.col("without")).alias("fewer")
    )
    parents = rules.select(F.col("tokens").alias("fewer"), "verdict", F.col("confidence").alias("parent"))
    parents = shorter.join(parents, ["fewer", "verdict"]).groupBy("tokens", "verdict").agg(F.max("parent").alias("parent"))
    strong = rules.filter(F.col("confidence") >= confidence).join(parents, ["tokens", "verdict"], "left")
    strong = strong.filter(F.col("parent").isNull() | (F.col("confidence") > F.col("parent")))
    single = whole.filter("size(tokens) = 1").select(F.col("tokens")[0].alias("token"), "all")
    rarest = (
        strong.select("tokens", "verdict", F.explode("tokens").alias("token"))
        .join(single, "token")
        .groupBy("tokens", "verdict")
        .agg(F.min_by("token", F.struct("all", "token")).alias("anchor"))
    )
    return stored(strong.join(rarest, ["tokens", "verdict"]).select("tokens", "verdict", "confidence", "n", "anchor"))


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens`` and ``mined``, the verdict of the most confident rule that fits (then of more support, more tokens)."""
    own = rules.select(
        F.col("tokens").alias("needed"), F.col("verdict").alias("mined"), "confidence", "n", F.col("anchor").alias("token")
    )
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(own, "token")
    hits = hits.filter(F.size(F.array_except("needed", "tokens")) == 0)
    order = F.struct("confidence", "n", F.size("needed"), F.array_join("needed", " "))
    return hits.groupBy("tokens").agg(F.max_by("mined", order).alias("mined"))


def judge_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each row.

    Labelled addresses are those a written rule decides, and otherwise the pages whose id has a quality label (0 blocks, 1
    allows; several labels count each). Addresses no rule fits get ``DEFAULT``, so do null and empty ones. Repeated rows are
    judged each; rows without an id as well. Equal token sets are matched once.
    """
    rows = stored(described(pages))
    quality = labels.select(
        F.col("doc_id").cast("long").alias("page_id"),
        F.when(F.col("quality") == 0, "block").when(F.col("quality") == 1, "allow").alias("labelled"),
    )
    ruled = rows.filter(F.col("ruled").isNotNull()).select("tokens", F.col("ruled").alias("verdict"))
    other = rows.filter(F.col("ruled").isNull()).join(quality, "page_id").select("tokens", F.col("labelled").alias("verdict"))
    rules = mine_rules(ruled.unionByName(other))
    mined = match_rules(rows.filter(F.col("ruled").isNull()).select("tokens").distinct(), rules)
    mined = mined.select(F.col("tokens").alias("own"), "mined")
    verdict = F.coalesce("ruled", "mined", F.lit(DEFAULT))
    return rows.join(mined, F.col("tokens") == F.col("own"), "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict")
    )


def op4_association_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read_table(spark, folder, "pages"), read_table(spark, folder, "labels"))
