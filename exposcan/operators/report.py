"""Run reports and JSON quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposcan.functions.json_text import valid_json
from exposcan.session import materialise

FILES_PER_PART = 10_000


def quarantine(files: DataFrame, json: str) -> tuple[DataFrame, DataFrame]:
    """Files whose text is JSON, and the others."""
    judged = files.withColumn("_valid", valid_json(F.col(json)))
    return judged.where("_valid").drop("_valid"), judged.where("NOT _valid").drop("_valid")


def run_report(outcomes: DataFrame, per_part: int = FILES_PER_PART) -> DataFrame:
    """``status, part, n, files`` from ``file, status``: every file is listed.

    A status lists its files in parts of about ``per_part``, so that no list grows with the
    run; ``n`` counts the files of the part.
    """
    outcomes = materialise(outcomes.select("file", "status"))
    parts = outcomes.groupBy("status").agg(F.ceil(F.count("*") / per_part).alias("parts"))
    placed = outcomes.join(parts, "status").select(
        "status", "file", F.pmod(F.xxhash64("file"), F.col("parts")).cast("int").alias("part")
    )
    return placed.groupBy("status", "part").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list("file")).alias("files")
    )
