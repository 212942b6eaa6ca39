"""File listings, whole texts and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exposcan.functions.ids import base_name, content_sha1, file_ext
from exposcan.functions.text import lines_of, valid_utf8, without_last_newline

SUFFIXES = {
    "csv": [".csv"],
    "sheet": [".xls", ".xlsx"],
    "xml": [".xml"],
    "pdf": [".pdf"],
    "office": [".doc", ".docx", ".ppt", ".pptx"],
}


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """``path, name, ext, size`` of every file below ``directory``; no file is opened.

    Link flags are not part of a distributed listing; add ``is_link`` where it is known.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    path = F.col("path")
    return listed.select(
        "path",
        base_name(path).alias("name"),
        file_ext(path).alias("ext"),
        F.col("length").cast("bigint").alias("size"),
    )


def read_texts(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """``path, text, sha1, decodable``: whole files (up to 2 GB each).

    Undecodable bytes are dropped from the text; the hash is of the bytes as they are.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(directory, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        valid_utf8(F.col("value")).alias("text"),
        content_sha1(F.col("value")).alias("sha1"),
        F.is_valid_utf8("value").alias("decodable"),
    )


def read_pieces(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """``path, size, block, place, line``: files of any size, read in splits and once.

    Lines are cut at line feeds only and are as the bytes are: carriage returns stay. ``block`` is where the split starts in
    its file and ``place`` grows by one per line within it, so the two order the lines of a file without
    counting them.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(directory).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def cut_pieces(files: DataFrame, file: str, text: str, lines_per_block: Column | None = None) -> DataFrame:
    """The same of whole texts, which are one block each unless ``lines_per_block`` cuts them.

    Texts without ``@`` hold no finding and are left out.
    """
    body = without_last_newline(F.col(text))
    lines = F.when(F.col(text) == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))
    block = F.floor(F.col("pos") / lines_per_block) if lines_per_block is not None else F.lit(0).cast("bigint")
    return files.where(F.col(text).contains("@")).select(
        "*", F.octet_length(text).cast("bigint").alias("size"), F.posexplode(lines).alias("pos", "line")
    ).select(F.col(file).alias("path"), "size", block.alias("block"), F.col("pos").cast("bigint").alias("place"), "line")


def read_lines(files: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, line_no, line`` from whole texts."""
    return files.select(
        F.col(doc).alias("doc"), F.posexplode(lines_of(F.col(text))).alias("pos", "line")
    ).select("doc", (F.col("pos") + 1).alias("line_no"), "line")


def is_json_name(name: Column) -> Column:
    """The one suffix that is matched with its case."""
    return name.endswith(".json")


def has_suffix(name: Column, kind: str) -> Column:
    lowered = F.lower(name)
    hit = F.lit(False)
    for suffix in SUFFIXES[kind]:
        hit = hit | lowered.endswith(suffix)
    return hit


def select_json(files: DataFrame, name: str = "name") -> DataFrame:
    return files.where(is_json_name(F.col(name)))


def select_kind(files: DataFrame, kind: str, name: str = "name") -> DataFrame:
    return files.where(has_suffix(F.col(name), kind))
