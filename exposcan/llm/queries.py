"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposcan.llm import ann, decontaminate, jaccard, licenses, manifest, mixing, periodic, pii, quality, repeats, token_counts, toxicity, urls
from exposcan.llm.oracle import ORACLE as ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Vocabulary of the token counts.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.read_pieces(PIECES))


@query
def op2_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op3_url_filter(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


@query
def op4_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_jaccard_groups(spark, sf_dir):
    return jaccard.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_substring_dedup(spark, sf_dir):
    return repeats.repeated_words(table(spark, sf_dir, "documents"))


def unsigned_crc(doc_id):
    """``crc32`` of the id in decimal, unsigned; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def with_planted_runs(docs):
    """Words from a place on repeated with a period, in every tenth document: the words of the others stay as they are."""
    code = unsigned_crc(F.col("doc_id"))
    words = F.when(code % 10 == 0, F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    rows = docs.select("doc_id", "text", words.alias("words"), F.floor(code / 10).alias("g")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, 0)").cast("int"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)").cast("int"))
    unit = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("cast((n - a + p - 1) div p as int)"))
    planted = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(unit), F.lit(1), F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query
def op12_merkle_manifest(spark, sf_dir):
    """Every fifth document is found lower-cased when the proofs are checked."""
    text = F.when(unsigned_crc(F.col("doc_id")) % 5 == 0, manifest.lower_cased(F.col("text"))).otherwise(F.col("text"))
    rows = manifest.manifest(table(spark, sf_dir, "documents"), found={"text": text})
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


@query
def op13_personal_data(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
