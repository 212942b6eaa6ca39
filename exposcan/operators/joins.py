"""Joins that hold when one key owns a third of the rows.

They are plain equi-joins with the many rows on the left. The engine broadcasts a side whose measured size allows it, and
measures the partitions of the others at run time: what a hot key makes too large it splits over as many tasks as its rows
need (``spark.sql.adaptive.skewJoin``), and only for that part the other side is read again. No side is copied beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv


def latest_sources(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per id, the last registered, and the rows left out of it.

    Ids that were no number are registered as 0 and name no source. Equal times are settled by all columns.
    """
    columns = [c for c in sources.columns if c != "id"]
    first = [c for c in ("indexed", "discovered") if c in columns]
    order = F.struct(*first, *[c for c in columns if c not in first])
    good = sources.where(F.col("id").isNotNull() & (F.col("id") != 0))
    latest = good.groupBy("id").agg(F.max(order).alias("row"), F.count("*").alias("n"))
    chosen = latest.select(*[F.col("id") if c == "id" else F.col(f"row.{c}") for c in sources.columns])
    bad = sources.where(F.col("id").isNull() | (F.col("id") == 0))
    older = good.join(latest.where("n > 1").select("id", "row"), "id").where(order != F.col("row")).select(*sources.columns)
    return chosen, bad.unionByName(older)


def attach_source(findings: DataFrame, sources: DataFrame) -> DataFrame:
    """Findings of registered sources, each with its source's columns: at most one row per finding.

    A plain join: the engine broadcasts the sources if they are few and splits a hot source if not.
    """
    chosen, _ = latest_sources(sources)
    return findings.join(chosen.withColumnRenamed("id", "id_source"), "id_source")


def keep_qualified(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Rows of the files that passed a file-level verdict."""
    return rows.join(files.select(key), key, "left_semi")


def _extension_table(files: DataFrame) -> DataFrame:
    return files.sparkSession.createDataFrame(list(fv.BUCKET_OF_EXTENSION.items()), "ext string, bucket string")


def route_lookup(files: DataFrame, how: str = "left") -> DataFrame:
    """``bucket`` by lower-case ``ext``. The lookup table is fixed (46 rows), hence the broadcast."""
    return files.join(F.broadcast(_extension_table(files)), "ext", how)


def bucket_or_text(ext: Column, bucket: Column) -> Column:
    return F.when(ext == "", F.lit(fv.TEXT_BUCKET)).otherwise(bucket)
