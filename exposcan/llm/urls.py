"""URL rules by hashed host and path expressions.

Every url is expanded into the expressions "host suffix + path prefix" that a rule could be
written as. Expressions and rules are joined on the first digits of their SHA-256, the full digest
confirms a match, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of a digest that are joined on.
PREFIX = 8
#: Rules up to this number go to every task (some 100 bytes each).
BROADCAST_RULES = 100_000
#: Verdict on urls no rule fits.
DEFAULT = "allow"

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased in A-Z."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages`` (page_id, url).

    ``rules`` has verdict, host and path; a rule fits its host and all its subdomains if the path starts with the
    rule's. The longest rule (host and path together) wins, then the longest host, then a block.
    ``rule`` is host and path of it, null where none fits; the verdict is then ``default``. A null
    url or one without ``://`` has an empty host and path. Repeated rows get a row each. Rules
    with nulls fit nothing. Other columns, such as the page, are not read.
    """
    rules = rules.filter("verdict is not null and host is not null and path is not null").select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path")
    text = F.concat("host", "path")
    # Hosts of which lengths, and paths of which lengths, occur: one row of small numbers.
    shape = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths"), F.count("*").alias("n")).first()
    digest = F.sha2(F.concat("host", F.lit(" "), "path"), 256)
    rank = F.struct(
        F.length(text).alias("size"), F.length("host").alias("host_size"), (F.col("verdict") == "block").cast("int").alias("blocks"), text.alias("rule"), "verdict"
    )
    known = rules.select(digest.alias("known"), rank.alias("rank")).groupBy("known").agg(F.max("rank").alias("rank")).withColumn("key", F.substring("known", 1, PREFIX))

    # One row per distinct page, host and path; how often it occurs is written out again at the end.
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.groupBy("page_id", "host", "path").agg(F.count("*").alias("times"))
    parts = F.split("host", r"\.")
    numbers = lambda values: F.array(*[F.lit(v) for v in sorted(values)]).cast("array<int>")
    suffixes = F.transform(F.filter(numbers(shape["labels"]), lambda n: n <= F.size(parts)), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    prefixes = F.transform(F.filter(numbers(shape["lengths"]), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.sha2(F.concat(s, F.lit(" "), p), 256))))
    asked = rows.withColumn("digest", F.explode_outer(both)).withColumn("key", F.substring("digest", 1, PREFIX))
    few = shape["n"] <= BROADCAST_RULES
    hits = asked.join(F.broadcast(known) if few else known, "key", "left").withColumn("rank", F.when(F.col("known") == F.col("digest"), F.col("rank")))
    best = hits.groupBy("page_id", "times", "host", "path").agg(F.max("rank").alias("rank"))
    return best.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(
        "page_id", "host", "path", F.col("rank.rule").alias("rule"), F.coalesce("rank.verdict", F.lit(default)).alias("verdict")
    )
