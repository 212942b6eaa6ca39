"""A whole run: from a folder to the index, with one ledger row for every file in it.

Listing, routing, lanes and upsert are the ones of the other modules. Files are chosen by name before they are read; verdicts that need the
content are taken from the extracts of the lanes, so no file is read again for the ledger but XML documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions import ids
from exposcan.functions.markup import well_formed_xml
from exposcan.operators.routing import flatten_collisions, route_by_extension, verdict
from exposcan.operators.sinks import Protection
from exposcan.operators.sniff import sniff_xml_text
from exposcan.plans.index import index_rows, index_run
from exposcan.plans.lanes import csv_cut_findings, file_digests, split_findings, split_text_findings, xml_lane
from exposcan.session import many_files, materialise
from exposcan.sources.csv_pieces import csv_contacts, cut_csv
from exposcan.sources.files import read_pieces, read_texts
from exposcan.sources.listing import list_all_files

#: Ledger verdicts, each with what it means.
VERDICTS = {
    "link": "a link, whatever it points to",
    "small": "under the least size",
    "unknown_extension": "of no known kind",
    "hidden": "named so that the engine's readers leave it out; rename it to have it read",
    "replaced": "another file of its bucket and name comes later",
    "needs_decoder": "of a kind that has to be decoded to a table first",
    "copy": "equal to a file with a smaller path",
    "no_contact": "nothing in its head speaks for addresses",
    "not_parsed": "no well-formed document",
    "nothing_found": "read, no address in it",
    "found": "read, with addresses",
}


def plain_path(path: Column) -> Column:
    """A path as the listing gives it, from the URI of Spark's readers."""
    return F.url_decode(F.replace(F.regexp_replace(path, r"\Afile:/+", "/"), F.lit("+"), F.lit("%2B")))


def is_hidden(path: Column, root: str) -> Column:
    """Whether Spark's readers leave the file out for its name or that of a folder above it, up to ``root``."""
    parts = F.split(F.substring(path, F.lit(len(root.rstrip("/")) + 2), F.length(path)), "/")
    return F.exists(parts, lambda p: p.startswith(".") | (p.startswith("_") & ~p.contains("=")) | p.endswith("._COPYING_"))


def routed_files(files: DataFrame, root: str, flatten: bool = True) -> DataFrame:
    """``path, name, ext, size, bucket, verdict`` of a listing; ``kept`` files go on.

    With ``flatten``, of files with one bucket and name only that of the greatest path stays.
    """
    routed = route_by_extension(files).withColumn("verdict", verdict())
    hidden = (F.col("verdict") == "kept") & is_hidden(F.col("path"), root)
    routed = routed.withColumn("verdict", F.when(hidden, "hidden").otherwise(F.col("verdict"))).drop("is_link")
    if not flatten:
        return routed
    stays = flatten_collisions(routed.where("verdict = 'kept'")).select("path", F.lit(True).alias("stays"))
    left_out = (F.col("verdict") == "kept") & F.col("stays").isNull()
    return routed.join(stays, "path", "left").withColumn("verdict", F.when(left_out, "replaced").otherwise(F.col("verdict"))).drop("stays")


def run_folder(
    spark: SparkSession, directory: str, sources: DataFrame, id_source: int, root: str, protection: Protection | None, flatten: bool = True
) -> DataFrame:
    """Index the text, csv and XML files below ``directory`` and return the ledger.

    The findings are upserted into the index below ``root`` if ``id_source`` is registered in ``sources``. The ledger
    (``path, bucket, verdict, findings``) has every file of the folder once; ``findings`` counts the addresses, or for csv files
    the records with one, before the index merges them.
    """
    with many_files(spark):
        return _run(spark, directory, sources, id_source, root, protection, flatten)


def _run(spark, directory, sources, id_source, root, protection, flatten) -> DataFrame:
    files = materialise(routed_files(list_all_files(spark, directory), directory, flatten))
    kept = files.where("verdict = 'kept'").select("path", "name", "ext", "bucket")
    text, csv, xml = (kept.where(c).select("path") for c in (F.col("bucket") == fv.TEXT_BUCKET, F.col("ext") == "csv", F.col("ext") == "xml"))

    def named(pieces: DataFrame, path: str = "path") -> DataFrame:
        return pieces.withColumn(path, plain_path(F.col(path)))

    ext = ids.file_ext(F.col("path"))
    of_text = [e for e, bucket in fv.BUCKET_OF_EXTENSION.items() if bucket == fv.TEXT_BUCKET]
    pieces = read_pieces(spark, directory)  # for both kinds, as each reader lists the folder
    splits = split_findings(pieces.where(ext.isin("", *of_text)))
    splits = materialise(named(splits).join(text, "path", "left_semi"))
    text_found = split_text_findings(splits)
    first = file_digests(splits).groupBy("digest").agg(F.min("path").alias("path")).select("path", F.lit("read").alias("state"))
    text_states = text.join(first, "path", "left").select("path", F.coalesce("state", F.lit("copy")).alias("state"))

    cut = materialise(named(cut_csv(pieces.where(ext == "csv"))).join(csv, "path", "left_semi"))
    contacts = csv_contacts(cut, named(pieces.where(ext == "csv")))
    csv_found = csv_cut_findings(cut, contacts)
    csv_states = csv.join(contacts, "path", "left").select(
        "path", F.when(F.col("contact"), "read").otherwise("no_contact").alias("state"))

    # Without XML files the folder is not listed once more.
    texts = spark.createDataFrame([], "path string, text string") if xml.isEmpty() else read_texts(spark, directory)
    documents = named(texts.where(ids.file_ext(F.col("path")) == "xml"))
    xml_found = xml_lane(documents, "path", "text").join(xml.withColumnRenamed("path", "file"), "file", "left_semi")
    judged = F.when(~sniff_xml_text(F.col("text")), "no_contact").when(~F.coalesce(well_formed_xml(F.col("text")), F.lit(False)), "not_parsed").otherwise("read")
    xml_states = xml.join(documents.select("path", judged.alias("state")), "path")

    base = ids.base_name(F.col("file"))
    rows = [
        index_rows(text_found, "txt", F.concat(base, F.lit(".json")), F.lit(id_source)),
        index_rows(csv_found, "csv", F.concat(F.lit("transformed_"), ids.file_stem(base), F.lit(".json")), F.lit(id_source), F.col("row_no")),
        index_rows(xml_found, "xml", F.concat(ids.file_stem(base), F.lit(".json")), F.lit(id_source)),
    ]
    found = materialise(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    index_run([found], sources, root, protection)

    counts = found.groupBy(F.col("file").alias("path")).agg(F.count("*").alias("findings"))
    states = text_states.unionByName(csv_states).unionByName(xml_states)
    read = F.when(F.coalesce("findings", F.lit(0)) > 0, "found").otherwise("nothing_found")
    final = F.when(F.col("verdict") != "kept", F.col("verdict")).when(F.col("state").isNull(), "needs_decoder").when(F.col("state") == "read", read).otherwise(F.col("state"))
    return files.join(states, "path", "left").join(counts, "path", "left").select(
        "path", "bucket", final.alias("verdict"), F.coalesce("findings", F.lit(0)).cast("bigint").alias("findings"))
