"""Duplicates: of contents, of addresses, of findings.

Every reduction here is an aggregate that combines before the shuffle, so a group of copies
that holds a third of all rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.ids import content_sha1


def dedup_files(files: DataFrame, file: str, content: str) -> DataFrame:
    """``file, sha1``: of equal contents the smallest file. Only the hash is shuffled."""
    hashed = files.select(F.col(file).alias("file"), content_sha1(F.col(content)).alias("sha1"))
    return hashed.groupBy("sha1").agg(F.min("file").alias("file")).select("file", "sha1")


def skip_seen(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Deduplicated ``files`` whose ``sha1`` is not in ``seen``; both sides have one row per hash."""
    return files.join(seen.select("sha1").distinct(), "sha1", "left_anti")


def first_per_email(found: DataFrame, keys: list[str], order: list[str], value: Column) -> DataFrame:
    """Keys and ``value`` of the earliest row per key."""
    return found.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("email_context"))


def last_per_email(
    found: DataFrame, keys: list[str], order: list[str], value: Column, *more: Column
) -> DataFrame:
    """Keys and ``value`` of the latest row per key."""
    return found.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("email_context"), *more)


def lane_rank(lane: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in fv.LANE_ORDER]), lane).cast("int")


def dedup_by_id(findings: DataFrame, order: list[str]) -> DataFrame:
    """The last write per ``id``. Rows with an empty id are no duplicates of each other."""
    rest = [c for c in findings.columns if c != "id"]
    own = F.when(F.col("id") == "", F.struct(*order))
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return findings.groupBy("id", own.alias("own")).agg(last).select("id", "last.*")


def findings_per_file(findings: DataFrame, file: str) -> DataFrame:
    """``file, emails``: distinct addresses per file, counted after removing repeats."""
    distinct = findings.select(F.col(file).alias("file"), "email").distinct()
    return distinct.groupBy("file").agg(F.count("*").alias("emails"))
