"""Places of rows within their groups, however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from exposcan.llm.storage import settle


def placed(rows: DataFrame, group: str, order: list[str], of_group: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``idx``, the number from 0 of each row among those of its ``group`` in the order given.

    Rows are dealt by ranges of group and order, so a hot group spreads over as many tasks as it fills, and are
    numbered through in each task. What moves besides is a count per task and group. ``order`` has to tell
    rows apart, else equal ones land in one task. The columns of ``of_group`` (one row per group) are added.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = settle(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed").withColumn("_task", F.shiftright("_at", 33))
    tasks = dealt.groupBy(group, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(group).orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    tasks = tasks.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    if of_group is not None:
        tasks = tasks.join(of_group, group)
    numbered = dealt.join(tasks, [group, "_task"])
    return numbered.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_task", "_first", "_before")
