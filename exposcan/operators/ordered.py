"""Order within a document: running sums, heads and ordered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.text import fold_sizes, stripped_length, stripped_size

CHUNK = 1024


def running_chars(blocks: DataFrame, limit: int = fv.DIGITAL_CHARS) -> DataFrame:
    """``doc, seq, text, chars_before`` of the blocks an early-stopping reader would read.

    A block is read while the blocks before it hold at most ``limit`` characters. Sums are
    taken per chunk of positions first, so no window spans a whole document and chunks past
    the limit are dropped before their blocks are shuffled into order.
    """
    chunked = blocks.select(
        "doc", "seq", "text", F.floor(F.col("seq") / CHUNK).alias("chunk"), F.length("text").alias("n")
    )
    chunks = chunked.groupBy("doc", "chunk").agg(F.sum("n").alias("n"))
    before_chunk = Window.partitionBy("doc").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunks.withColumn("start", F.coalesce(F.sum("n").over(before_chunk), F.lit(0)))
        .where(F.col("start") <= limit)
        .select("doc", "chunk", "start")
    )
    before = Window.partitionBy("doc", "chunk").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.join(starts, ["doc", "chunk"])
        .withColumn("chars_before", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where(F.col("chars_before") <= limit)
        .select("doc", "seq", "text", "chars_before")
    )


def head_n(rows: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows per key; each task keeps ``n`` per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= n)


def concat_ordered(parts: DataFrame, doc: str, seq: str, text: str, separator: str = "") -> DataFrame:
    """``doc, text``: the parts of a document in order. A document is one value, so one row."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("seq"), F.col(text).alias("text"))))
    return parts.groupBy(F.col(doc).alias("doc")).agg(ordered.alias("parts")).select(
        "doc", F.array_join(F.transform("parts", lambda p: p["text"]), separator).alias("text")
    )


def stripped_chars(parts: DataFrame, doc: str, seq: str, text: Column) -> DataFrame:
    """``doc, chars``: length of the trimmed concatenation, without building it.

    Each part shrinks to four numbers before the shuffle; parts fold into chunks and chunks
    into documents, in order.
    """
    sized = parts.select(
        F.col(doc).alias("doc"),
        F.col(seq).alias("seq"),
        F.floor(F.col(seq) / CHUNK).alias("chunk"),
        stripped_size(text).alias("size"),
    )
    chunks = _fold(sized, ["doc", "chunk"], "seq")
    return fold_documents(chunks)


def fold_documents(chunks: DataFrame) -> DataFrame:
    """``doc, chars`` from the summaries of a document's chunks."""
    return _fold(chunks, ["doc"], "chunk").select("doc", stripped_length(F.col("size")).alias("chars"))


def _fold(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("size").alias("size"))))
    return rows.groupBy(*keys).agg(ordered.alias("all")).select(
        *keys, fold_sizes(F.transform("all", lambda e: e["size"])).alias("size")
    )
