"""Which files of a dump go where. Inputs are never moved or deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame

from exposcan.operators.routing import (
    drop_links, drop_small, drop_unknown_extension, flatten_collisions, route_by_extension, verdict,
)


def organise(files: DataFrame) -> DataFrame:
    """The files that stay, with their bucket; one per bucket and name."""
    return flatten_collisions(drop_unknown_extension(drop_small(drop_links(files))))


def file_verdicts(files: DataFrame) -> DataFrame:
    """Every file with its bucket and the reason it is left out, if any."""
    return route_by_extension(files).withColumn("verdict", verdict())
