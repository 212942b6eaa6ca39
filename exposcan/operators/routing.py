"""Which files count, and where they go."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.operators.joins import bucket_or_text, route_lookup


def drop_small(files: DataFrame, min_bytes: int = fv.MIN_FILE_BYTES) -> DataFrame:
    return files.where(F.col("size") >= min_bytes)


def drop_links(files: DataFrame) -> DataFrame:
    return files.where(~F.col("is_link"))


def route_by_extension(files: DataFrame) -> DataFrame:
    """Adds ``bucket``; null where the extension is unknown."""
    lowered = files.withColumn("ext", F.lower("ext"))
    return route_lookup(lowered).withColumn("bucket", bucket_or_text(F.col("ext"), F.col("bucket")))


def drop_unknown_extension(files: DataFrame) -> DataFrame:
    return route_by_extension(files).where(F.col("bucket").isNotNull())


def verdict() -> Column:
    """Why a routed file is left out, or ``kept``."""
    return (
        F.when(F.col("is_link"), "link")
        .when(F.col("size") < fv.MIN_FILE_BYTES, "small")
        .when(F.col("bucket").isNull(), "unknown_extension")
        .otherwise("kept")
    )


def is_identity_title(name: Column) -> Column:
    """Names of application papers go to identity review instead of a text lane."""
    lowered = F.lower(name)
    companion = reduce(Column.__or__, [lowered.contains(word) for word in fv.TITLE_COMPANIONS])
    return lowered.contains(fv.TITLE_WORD) & companion


def route_by_title(files: DataFrame, name: str = "name") -> DataFrame:
    """Adds ``identity_review``; the name of such files is lower-cased."""
    review = is_identity_title(F.col(name))
    return files.withColumn("identity_review", review).withColumn(
        name, F.when(F.col("identity_review"), F.lower(name)).otherwise(F.col(name))
    )


def flatten_collisions(files: DataFrame) -> DataFrame:
    """One file per bucket and name: the one with the greatest path.

    An aggregate, not a window: a name that half of all folders share is reduced before the
    shuffle.
    """
    others = [c for c in files.columns if c not in ("bucket", "name", "path")]
    last = F.max_by(F.struct("path", *others), F.col("path")).alias("last")
    return files.groupBy("bucket", "name").agg(last).select("bucket", "name", "last.*")
