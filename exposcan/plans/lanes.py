"""From decoded inputs to findings, one lane per kind of file.

Each lane gives ``file, email, email_context, id, origin``. Texts are scanned once and
cut down to findings before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions import ids
from exposcan.functions.emails import RFC, emails_in_context, rfc_emails, valid_email
from exposcan.functions.json_text import python_json
from exposcan.functions.line_contexts import line_contexts
from exposcan.functions.markup import xml_text
from exposcan.functions.tabular import clean_values, csv_cells, csv_columns, first_email_field, may_have_email, record_context
from exposcan.functions.digests import file_digest, line_terms, summed_terms
from exposcan.functions.text import fold_sizes, let, lines_of, newline_to_space, strip, stripped_size, valid_utf8
from exposcan.operators.dedup import first_per_email, last_per_email
from exposcan.operators.joins import keep_qualified
from exposcan.operators.ordered import CHUNK, fold_documents
from exposcan.operators.routing import is_identity_title
from exposcan.operators.sniff import (
    digital_extension, has_contact_header, office_digital_blocks, sniff_csv_text, sniff_xml_text,
)
from exposcan.session import by_passes, free_shuffles, materialise, with_once
from exposcan.sources.csv_pieces import csv_contacts, csv_piece_records, cut_csv
from exposcan.sources.records import csv_record_texts, cut_records

FINDING = ["file", "email", "email_context", "id", "origin"]


def line_findings(lines: DataFrame, *keep: str) -> DataFrame:
    """``keep, email, email_context`` of each address of each line of ``lines``."""
    valid = F.array_distinct(F.filter(rfc_emails(F.col("line")), valid_email))
    return (
        lines.where(F.col("line").contains("@"))
        .select(*keep, F.explode(line_contexts(F.col("line"), valid)).alias("hit"))
        .select(*keep, "hit.*")
    )


def _line_hits(line: Column) -> Column:
    """Addresses of a line, with context; of lines a carriage return parts the first that has the address counts."""

    def hits(one: Column) -> Column:
        return line_contexts(one, F.array_distinct(F.filter(rfc_emails(one), valid_email)))

    def first_of_each(found: Column) -> Column:
        return F.filter(found, lambda h, i: ~F.exists(F.slice(found, 1, i), lambda g: g["email"] == h["email"]))

    parts = F.when(line.contains("\r"), lines_of(line)).otherwise(F.array(line))
    found = let(parts, lambda ps: let(F.flatten(F.transform(ps, hits)), lambda f: F.when(F.size(ps) > 1, first_of_each(f)).otherwise(f)))
    return F.when(line.contains("@"), found).otherwise(F.array().cast("array<struct<email:string,email_context:string>>"))


def split_findings(pieces: DataFrame) -> DataFrame:
    """One row per split of a file, and one per address and context in it, from ``path, size, block, place, line``.

    Rows with an ``email`` are findings, with the ``place`` of their first line. The other ones sum up the lines of the split. All
    of it is combined in the scan by one hash aggregate.
    """
    none = F.lit(None).cast("string")
    mark = F.struct(none.alias("email"), none.alias("email_context"))
    hits = with_once(pieces, hits=F.concat(F.array(mark), _line_hits(valid_utf8(F.col("line")))))
    rows = hits.select("path", "size", "block", "place", *line_terms("line", "place"), F.explode("hits").alias("hit"))
    terms = [c for c in rows.columns if c not in ("path", "size", "block", "place", "hit")]
    of_line = F.col("hit.email").isNull()
    rows = rows.select("path", "size", "block", "place", "hit.*", *[F.when(of_line, F.col(c)).alias(c) for c in terms])
    return rows.groupBy("path", "size", "block", "email", "email_context").agg(F.min("place").alias("place"), *summed_terms())


def file_digests(splits: DataFrame) -> DataFrame:
    """``path, digest`` of files from their split rows. A file of a terabyte has some 8,000 of these."""
    columns = [c for c in splits.columns if c not in ("path", "size", "block", "email", "email_context")]
    parts = splits.where("lines > 0").groupBy("path", "size").agg(
        F.array_sort(F.collect_list(F.struct("block", *columns))).alias("parts"))
    return parts.select("path", file_digest("parts", "size").alias("digest"))


def text_lane(pieces: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Findings of text files of any size, from ``path, size, block, place, line``; equal contents count once.

    Files are read once, in whatever splits. Equal files have equal digests however they are cut, and equal findings; of copies
    the smallest path stays. ``seen`` holds the ``digest`` of files that an earlier run has read.
    """
    return split_text_findings(split_findings(pieces), seen)


def split_text_findings(splits: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Findings of text files from their split rows."""
    # Both branches take whole rows and choose them by a count, so that the files are scanned once for both.
    row = F.struct("email_context", *[c for c in splits.columns if c not in ("path", "size", "block", "email", "email_context")])
    found = splits.where("lines = 0").groupBy("path", "email").agg(F.min_by(row, F.struct("block", "place"))["email_context"].alias("email_context"))
    # A plain join: the engine splits a file that holds a large share of the findings.
    first = found.join(file_digests(splits), "path").groupBy("digest", "email").agg(
        F.min("path").alias("file"), F.min_by("email_context", "path").alias("email_context")
    )
    if seen is not None:
        first = first.join(seen.select("digest").distinct(), "digest", "left_anti")
    return first.select(
        "file",
        "email",
        "email_context",
        ids.finding_id_text(F.col("email"), F.col("email_context")).alias("id"),
        ids.base_name(F.col("file").cast("string")).alias("origin"),
    )


def context_findings(texts: DataFrame, text: str, radius: int, *keep: str) -> DataFrame:
    """``keep, pos, email, before, after`` of each address of each text."""
    return texts.select(*keep, F.explode(emails_in_context(F.col(text), radius, RFC)).alias("hit")).select(
        *keep, "hit.*"
    )


def _whole() -> Column:
    return F.concat("before", "email", "after")


def pdf_lane(pages: DataFrame) -> DataFrame:
    """Findings of digital paged documents, from ``doc, name, page_no, text``.

    Page texts are scanned once: each page gives its findings and, for the verdict on the
    document, the size of its trimmed text. Both verdicts are then taken from that extract.
    """
    page = F.struct(F.lit(None).cast("string").alias("email"), F.lit(None).cast("int").alias("pos"),
                    F.lit(None).cast("string").alias("context"), stripped_size(F.col("text")).alias("size"))
    hits = F.transform(emails_in_context(F.col("text"), fv.TEXT_CONTEXT, RFC), lambda h: F.struct(
        h["email"].alias("email"),
        h["pos"].alias("pos"),
        newline_to_space(F.concat(h["before"], h["email"], h["after"])).alias("context"),
        F.lit(None).cast("struct<blank:boolean,n:bigint,lead:bigint,trail:bigint>").alias("size"),
    ))
    rows = (
        pages.where(~is_identity_title(F.col("name")))
        .select("doc", "name", "page_no", F.explode(F.concat(hits, F.array(page))).alias("row"))
        .select("doc", "name", "page_no", "row.*")
    )
    chunk = F.when(F.col("email").isNull(), F.floor(F.col("page_no") / CHUNK))
    sizes = F.when(F.col("email").isNull(), F.struct(F.col("page_no").alias("at"), F.col("size")))
    extract = materialise(rows.groupBy("doc", "name", "email", chunk.alias("chunk")).agg(
        F.max_by("context", F.struct("page_no", "pos")).alias("email_context"),
        F.min("page_no").alias("first_page"),
        F.array_sort(F.collect_list(sizes)).alias("sizes"),
    ))
    found = extract.where(F.col("email").isNotNull())
    digital = fold_documents(
        extract.where(F.col("email").isNull()).select("doc", "chunk", fold_sizes(
            F.transform("sizes", lambda e: e["size"])).alias("size"))
    ).where(F.col("chars") > fv.DIGITAL_CHARS)
    gate = found.where(F.col("first_page") <= fv.HEAD_PAGES).select("doc").distinct()
    qualified = gate.join(digital.select("doc"), "doc", "left_semi")
    kept = keep_qualified(found, qualified, "doc")
    return kept.select(
        F.col("doc").alias("file"),
        "email",
        "email_context",
        ids.finding_id_doc(F.col("email"), F.col("email_context")).alias("id"),
        ids.file_stem(F.col("name")).alias("origin"),
    )


def office_lane(blocks: DataFrame) -> DataFrame:
    """Findings of digital office documents, from ``doc, name, ext, seq, text``.

    The blocks of a document meet once; verdict, text and findings all come from that row.
    """
    readable = blocks.where(~is_identity_title(F.col("name")) & digital_extension(F.lower("ext")))
    docs = readable.groupBy("doc", "name", F.lower("ext").alias("ext")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("blocks"),
        F.bool_or(F.col("text").contains("@")).alias("candidate"),
    )
    texts = (
        docs.where("candidate")
        .select("doc", "ext", F.transform("blocks", lambda b: b["text"]).alias("blocks"))
        .where(office_digital_blocks(F.col("blocks")))
        .select("doc", "ext", F.array_join("blocks", "\n").alias("text"))
    )
    found = context_findings(texts, "text", fv.TEXT_CONTEXT, "doc", "ext")
    last = last_per_email(found, ["doc", "ext", "email"], ["pos"], newline_to_space(_whole()))
    return last.select(
        F.col("doc").alias("file"),
        "email",
        "email_context",
        ids.finding_id_doc(F.col("email"), F.col("email_context")).alias("id"),
        F.when(F.col("ext") == "pptx", fv.PPTX_ORIGIN).otherwise(fv.DOCX_ORIGIN).alias("origin"),
    )


def record_findings(records: DataFrame, whole_cell: bool, keep: Sequence[str] = ()) -> DataFrame:
    """``file, row_no, email, email_context, id`` of records that hold an address."""
    records = records.where(may_have_email(F.col("fields")))
    cleaned = with_once(
        records.select("file", "row_no", *keep, F.col("fields").alias("read")), fields=clean_values(F.col("read"))
    ).drop("read")
    hits = with_once(cleaned, hit=first_email_field(F.col("fields"), whole_cell)).where(F.col("hit").isNotNull())
    context = python_json(record_context(F.col("fields"), F.col("hit.name")))
    return hits.select("file", "row_no", *keep, F.col("hit.email").alias("email"), context.alias("email_context")).withColumn(
        "id", ids.finding_id_index(F.col("email"), F.col("email_context"))
    )


def csv_lane(files: DataFrame, file: str, text: str, decodable: str | None = None) -> DataFrame:
    """Findings of csv texts. Everything is row by row: no shuffle.

    ``decodable`` names the column that tells whether the file decoded; the others are left out.
    """
    readable = files.where(F.col(decodable)) if decodable else files
    kept = readable.where(sniff_csv_text(F.col(text)))
    records = csv_record_texts(kept, file, text).where(F.col("record").contains("@"))
    return record_findings(cut_records(records), whole_cell=False).withColumn("origin", F.lit(""))


def csv_piece_lane(pieces: DataFrame) -> DataFrame:
    """The same of csv files of any size, from ``path, block, place, line``: see ``sources.csv_pieces``.

    Header, verdict and records may cross splits. What is shuffled are the records with an address.
    """
    pieces = pieces.withColumn("path", F.col("path").cast("string"))
    cut = materialise(cut_csv(pieces))
    free_shuffles(cut.sparkSession)
    return csv_cut_findings(cut, csv_contacts(cut, pieces))


def csv_cut_findings(cut: DataFrame, contacts: DataFrame) -> DataFrame:
    """Findings of csv files from their splits, cut into records and pieces, and the verdicts on their heads."""
    kept = contacts.where("contact").select("path")

    def findings(some: DataFrame) -> DataFrame:
        records = csv_piece_records(some).join(kept, "path", "left_semi")
        headers = records.where(F.col("row_no") == 0).select(
            "path", csv_columns(F.col("record")).alias("columns"), F.size(csv_cells(F.col("record"))).alias("width"))
        rows = records.where(F.col("row_no") > 0).join(headers, "path").withColumnRenamed("path", "file")
        return record_findings(cut_records(rows), whole_cell=False).withColumn("origin", F.lit(""))

    return by_passes(cut, "path", findings)


def sheet_lane(records: DataFrame) -> DataFrame:
    """Findings of sheets, from ``file, row_no, fields``.

    A sheet counts if a column is headed like a contact, which every record shows by itself, or
    if one of its first rows holds an address, which is then a finding. So the verdict needs
    the findings only and the records are scanned once.
    """
    flagged = record_findings(
        records.withColumn("headed", has_contact_header(F.col("fields"))), whole_cell=True, keep=["headed"]
    )
    found = materialise(flagged)
    early = found.where(F.col("row_no") <= fv.HEAD_LINES).select("file")
    others = keep_qualified(found.where(~F.col("headed")), early, "file")
    return found.where("headed").unionByName(others).drop("headed").withColumn("origin", F.lit(""))


def xml_lane(files: DataFrame, file: str, xml: str) -> DataFrame:
    """Findings of XML texts."""
    # The sign may be written as a character reference.
    candidates = files.where(F.col(xml).contains("@") | F.col(xml).contains("&#"))
    texts = candidates.where(sniff_xml_text(F.col(xml))).select(
        F.col(file).alias("file"), xml_text(F.col(xml)).alias("text")
    )
    found = context_findings(texts, "text", fv.XML_CONTEXT, "file")
    last = last_per_email(found, ["file", "email"], ["pos"], strip(_whole()))
    return last.select(
        "file",
        "email",
        "email_context",
        ids.finding_id_index(F.col("email"), F.col("email_context")).alias("id"),
        F.lit("").alias("origin"),
    )
