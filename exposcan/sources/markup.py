"""XML documents, page tables and block tables as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposcan.functions import markup
from exposcan.functions.text import split_pages


def read_xml_text(docs: DataFrame, doc: str, xml: str) -> DataFrame:
    """``doc, text``; text is null for documents that do not parse."""
    return docs.select(F.col(doc).alias("doc"), markup.xml_text(F.col(xml)).alias("text"))


def page_text(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, page_no, text`` from texts that hold one page per line."""
    return docs.select(
        F.col(doc).alias("doc"), F.posexplode(split_pages(F.col(text))).alias("pos", "text")
    ).select("doc", (F.col("pos") + 1).alias("page_no"), "text")


def block_text(blocks: DataFrame, doc: str = "doc", seq: str = "seq", text: str = "text") -> DataFrame:
    """``doc, text``: the blocks of a document in order, one per line."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("seq"), F.col(text).alias("text"))))
    return blocks.groupBy(F.col(doc).alias("doc")).agg(ordered.alias("blocks")).select(
        "doc", F.array_join(F.transform("blocks", lambda b: b["text"]), "\n").alias("text")
    )
