"""One keyed findings table out of all lanes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions import ids
from exposcan.operators.dedup import dedup_by_id, lane_rank
from exposcan.operators.joins import attach_source
from exposcan.operators.sinks import Protection, upsert_findings
from exposcan.session import dropping, materialise_all

ORDER = ["lane", "file", "seq"]


def index_rows(
    found: DataFrame, lane: str | Column, json_name: Column, id_source: Column, seq: Column | None = None
) -> DataFrame:
    """A lane's findings as index rows, with the order in which they are written."""
    named = F.lit(lane) if isinstance(lane, str) else lane
    keyed = named.isin(fv.KEYED_LANES)
    provenance = F.when(keyed, ids.keyed_provenance(F.col("origin"), json_name)).otherwise(json_name)
    return found.select(
        "id",
        ids.normalise_email(F.col("email")).alias("email"),
        "email_context",
        ids.email_domain(F.col("email")).alias("domain"),
        provenance.alias("from"),
        id_source.cast("int").alias("id_source"),
        lane_rank(named).alias("lane"),
        F.col("file").cast("string").alias("file"),
        (F.lit(0) if seq is None else seq).cast("bigint").alias("seq"),
    )


def union_lanes(*lanes: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), lanes)


def union_dirs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both folders' files, repeats included."""
    return first.unionByName(second)


def index_all(*lanes: DataFrame) -> DataFrame:
    """The index after all lanes are written: one row per id, the last write wins."""
    return dedup_by_id(union_lanes(*lanes), ORDER).select(*fv.FINDING_FIELDS)


def index_run(lanes: Iterable[DataFrame], sources: DataFrame, root: str, protection: Protection | None) -> int:
    """All lanes' findings of registered sources, upserted into the index below ``root``: its new version.

    Several lanes are written one after the other, so that the shuffles of one are on disk at a time. Extracts that an iterator makes for
    a lane go when that lane is written, and all of it when the index is.
    """
    spark = sources.sparkSession

    def found(lane: DataFrame) -> DataFrame:
        return attach_source(lane, sources).select(*fv.FINDING_FIELDS, *ORDER)

    if isinstance(lanes, list) and len(lanes) == 1:
        return upsert_findings(found(lanes[0]), root, protection, ORDER)
    with dropping(spark):
        rows = materialise_all(spark, map(found, lanes))
        return upsert_findings(rows, root, protection, ORDER, staged=True)
