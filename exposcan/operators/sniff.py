"""File-level verdicts taken from a file's head or size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.emails import RELAXED, RFC, has_email
from exposcan.functions.tabular import csv_cells, csv_header
from exposcan.functions.text import first_lines, let, strip
from exposcan.operators.ordered import running_chars, stripped_chars


def _is_contact_header(name: Column) -> Column:
    return F.lower(name).isin(fv.CONTACT_HEADERS)


def sniff_csv_text(text: Column) -> Column:
    """Keep a csv text: a contact header, or an address in its first ten physical lines."""

    def verdict(head: Column) -> Column:
        # The header is the first line that is not blank; a byte order mark is not part of it.
        body = F.regexp_replace(head, r"\A\x{FEFF}?(?:[ \t]*+\n)*+", "")
        header = csv_header(body)
        return F.exists(csv_cells(header), _is_contact_header) | F.exists(
            F.split(head, "\n", -1), lambda line: has_email(line, RELAXED)
        )

    return F.coalesce(let(first_lines(text, fv.HEAD_LINES), verdict), F.lit(False))


def presence_any(rows: DataFrame, file: str, *tests: Column) -> DataFrame:
    """``file, present``: whether any test holds on any row of the file."""
    hit = F.lit(False)
    for test in tests:
        hit = hit | F.coalesce(test, F.lit(False))
    return rows.groupBy(F.col(file).alias("file")).agg(F.bool_or(hit).alias("present"))


def sniff_csv(lines: DataFrame) -> DataFrame:
    """``doc`` of the csv files to keep, from ``doc, line_no, line``."""
    head = lines.where(F.col("line_no") <= fv.HEAD_LINES)
    written = F.regexp_replace("line", r"\A\x{FEFF}", "").rlike(r"[^ \t]")
    verdicts = head.groupBy("doc").agg(
        F.bool_or(has_email(F.col("line"), RELAXED)).alias("present"),
        F.min_by(F.when(written, F.col("line")), F.when(written, F.col("line_no"))).alias("header"),
    )
    header = csv_cells(F.regexp_replace("header", r"\A\x{FEFF}", ""))
    contact = F.coalesce(F.exists(header, _is_contact_header), F.lit(False))
    return verdicts.where(F.col("present") | contact).select("doc")


def has_contact_header(fields: Column) -> Column:
    return F.exists(fields, lambda f: F.coalesce(_is_contact_header(f["name"]), F.lit(False)))


def sniff_sheet(records: DataFrame) -> DataFrame:
    """``file`` of the sheets to keep, from ``file, row_no, fields``."""
    head = records.where(F.col("row_no") <= fv.HEAD_LINES)
    cell = F.exists("fields", lambda f: ~f["raw"] & has_email(f["value"], RFC))
    verdicts = presence_any(head, "file", has_contact_header(F.col("fields")), cell)
    return verdicts.where("present").select("file")


def sniff_xml_text(xml: Column) -> Column:
    """Keep an XML text: the word anywhere, or an address in one of its first ten lines."""
    head = F.exists(
        F.split(first_lines(xml, fv.HEAD_LINES), "\n", -1), lambda line: has_email(line, RFC)
    )
    return F.coalesce(F.when(head, F.lit(True)).otherwise(F.lower(xml).contains("email")), F.lit(False))


def page_gate(pages: DataFrame, limit: int = fv.HEAD_PAGES) -> DataFrame:
    """``doc`` of the documents with an address on one of their first pages."""
    head = pages.where(F.col("page_no") <= limit)
    return head.where(has_email(F.col("text"), RFC)).select("doc").distinct()


def paged_digital(pages: DataFrame, limit: int = fv.DIGITAL_CHARS) -> DataFrame:
    """``doc, digital`` of paged documents: the trimmed text passes the limit."""
    return stripped_chars(pages, "doc", "page_no", F.col("text")).select(
        "doc", (F.col("chars") > limit).alias("digital")
    )


def office_digital(blocks: DataFrame, limit: int = fv.DIGITAL_CHARS) -> DataFrame:
    """``doc, digital`` of office documents, judged on the blocks read before the early stop."""
    read = running_chars(blocks, limit)
    joined = stripped_chars(read, "doc", "seq", F.concat(F.lit("\n"), F.col("text")))
    return joined.select("doc", (F.col("chars") > limit).alias("digital"))


def office_digital_blocks(blocks: Column, limit: int = fv.DIGITAL_CHARS) -> Column:
    """The same verdict on the ordered block texts of one document."""
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("text"))
    read = F.aggregate(
        blocks,
        start,
        lambda a, b: F.when(a["n"] > limit, a).otherwise(F.struct(
            (a["n"] + F.length(b)).alias("n"), F.concat(a["text"], F.lit("\n"), b).alias("text"))),
    )
    return F.length(strip(read["text"])) > limit


def digital_extension(ext: Column) -> Column:
    """Office formats whose text is read; the older binary ones always count as scanned."""
    return ext.isin("docx", "pptx")
