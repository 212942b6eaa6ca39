"""Sinks. Addresses and identity numbers are pseudonymised unless raw output is asked for."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.emails import mask_emails
from exposcan.functions.ids import parse_int
from exposcan.functions.text import strip
from exposcan.operators.dedup import dedup_by_id
from exposcan.session import in_passes


#: Runs beside the first one before they are merged, and bytes up to which the first is not merged with them early.
MOST_RUNS = 8
LEAST_BYTES = 1 << 20
_BLOCK = 64  # bytes of a block of SHA-256


@dataclass(frozen=True)
class Protection:
    """How personal values are written. The key is the caller's; there is no default.

    Values become keyed hashes (HMAC-SHA-256). The padded keys are read by subqueries when the plan runs: neither
    they nor the key stand in plans, logs of plans or event logs.
    """

    key: str = field(repr=False)

    def _pad(self, mix: int) -> Column:
        secret = self.key.encode()
        secret = (hashlib.sha256(secret).digest() if len(secret) > _BLOCK else secret).ljust(_BLOCK, b"\0")
        row = [(bytearray(k ^ mix for k in secret),)]
        return SparkSession.active().createDataFrame(row, "pad binary").scalar()

    def pseudonym(self, value: Column) -> Column:
        inner = F.unhex(F.sha2(F.concat(self._pad(0x36), value.cast("binary")), 256))
        return F.when(value != "", F.sha2(F.concat(self._pad(0x5C), inner), 256)).otherwise(value)

    def findings(self, rows: DataFrame) -> DataFrame:
        """The id is keyed too: it is a plain hash of the address and could be guessed."""
        return (
            rows.withColumn("email", self.pseudonym(F.lower("email")))
            .withColumn("id", self.pseudonym(F.col("id")))
            .withColumn("email_context", mask_emails(F.col("email_context")))
            .withColumn("from", mask_emails(F.col("from")))
        )

    def records(self, rows: DataFrame) -> DataFrame:
        """All that tells who somebody is; country, authority, gender and expiry stay."""
        named = {name: self.pseudonym(F.col(f"`{name}`")) for name in fv.IDENTIFYING_FIELDS}
        return rows.withColumns(named)


RAW = None


def _protected(rows: DataFrame, protection: Protection | None, kind: str) -> DataFrame:
    return rows if protection is RAW else getattr(protection, kind)(rows)


def write_findings(
    findings: DataFrame, path: str, protection: Protection | None, max_rows_per_file: int = 2_000_000
) -> None:
    """Parquet by source. Rebalancing splits a hot source over tasks and merges small ones."""
    rows = _protected(findings, protection, "findings").hint("rebalance", "id_source")
    writer = rows.write.mode("errorifexists").option("maxRecordsPerFile", max_rows_per_file)
    writer.partitionBy("id_source").parquet(path)


def merge_findings(target: DataFrame, batch: DataFrame, order: list[str] | None) -> DataFrame:
    """The target after the batch: a batch row replaces the target row with its id.

    The target is only filtered by the batch's ids, so a small batch never shuffles it. Empty
    ids replace nothing; they get keys of their own to stay off one reducer. Without ``order`` the ids of the batch are unique.
    """
    latest = batch if order is None else dedup_by_id(batch, order).drop(*[c for c in order if c not in target.columns])
    ids = latest.where(F.col("id") != "").select(F.col("id").alias("_key"))
    key = F.when(F.col("id") != "", F.col("id")).otherwise(
        F.concat(F.lit("empty "), F.xxhash64("email", "email_context", "from").cast("string"))
    )
    kept = target.withColumn("_key", key).join(ids, "_key", "left_anti").drop("_key")
    return kept.unionByName(latest.select(*target.columns))


def _folder(spark: SparkSession, root: str, name: str = ""):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}" if name else root)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str) -> int:
    """The highest published version below ``root``, 0 if there is none.

    A version counts once its pointer file exists. This does not depend on success markers, and a run
    that died leaves a folder that nothing points to.
    """
    path, fs = _folder(spark, root)
    if not fs.exists(path):
        return 0
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return max((int(m[1]) for m in map(re.compile(r"published-(\d+)\Z").match, names) if m), default=0)


def _runs(spark: SparkSession, root: str, version: int) -> list[str]:
    """The folders of a version, the oldest first."""
    if not version:
        return []
    pointer = f"{root}/published-{version}"
    named = [r["value"] for r in spark.read.text(pointer).collect()]  # a line per run, at most MOST_RUNS and one
    if not named:
        raise RuntimeError(f"{pointer} is empty: its writer died while publishing; delete it to go back to the version before")
    return named


def _merged(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    """The rows that count of some runs: of each id those of the latest run that has it.

    The later runs are merged by one aggregate; the first one is only filtered by their ids, so it is not shuffled while they are few.
    """
    first, *later = [spark.read.parquet(f"{root}/{run}").select(*fv.FINDING_FIELDS) for run in runs]
    if not later:
        return first
    numbered = [rows.withColumn("_run", F.lit(n)) for n, rows in enumerate(later)]
    batch = reduce(DataFrame.unionByName, numbered)
    unkeyed = batch.where("id = ''").drop("_run")
    latest = dedup_by_id(batch.where("id != ''"), ["_run"]).drop("_run")
    return merge_findings(first, latest.unionByName(unkeyed), None)


def read_findings(spark: SparkSession, root: str) -> DataFrame:
    """The findings of the latest version, merged as they are read."""
    return _merged(spark, root, _runs(spark, root, latest_version(spark, root)))


def _bytes(spark: SparkSession, root: str, run: str) -> int:
    path, fs = _folder(spark, root, run)
    return fs.getContentSummary(path).getLength()


def _publish(spark: SparkSession, root: str, version: int, data: str) -> None:
    """Create the pointer, which fails if another writer has published this version."""
    pointer, fs = _folder(spark, root, f"published-{version}")
    try:
        out = fs.create(pointer, False)
    except Exception as error:
        raise RuntimeError(f"version {version} below {root} is another writer's; run the upsert again") from error
    out.writeBytes(data)
    out.close()


def _write_run(rows: DataFrame, path: str, max_rows_per_file: int, lookup: bool, mode: str = "errorifexists") -> None:
    """Compressed Parquet; with a Bloom filter on the id for ``lookup``, so that only the row groups that may hold it are read."""
    writer = rows.sortWithinPartitions("id").write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_rows_per_file)
    if lookup:
        writer = writer.option("parquet.bloom.filter.enabled#id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def upsert_findings(
    batch: DataFrame, root: str, protection: Protection | None, order: list[str], max_rows_per_file: int = 2_000_000, staged: bool = False
) -> int:
    """Write the next version of the findings below ``root`` and return its number.

    A version is a list of runs, merged when they are read: an upsert writes its batch as a run of its own and leaves the others where
    they are. When there are ``MOST_RUNS`` beside the first, these are merged into one; when together they have half the bytes
    of the first, all are. So each row is written again a few times only, however many batches come. Every folder has a new name and none is ever
    overwritten; of two writers that start from the same version the second to finish fails. A batch that is ``staged``, an extract written
    before, goes in passes by id if it is large.
    """
    spark = batch.sparkSession
    version = latest_version(spark, root)
    runs = _runs(spark, root, version)

    def latest(some: DataFrame) -> DataFrame:
        return dedup_by_id(_protected(some, protection, "findings"), order).select(*fv.FINDING_FIELDS)

    def written(passes: Iterable[DataFrame], lookup: bool = False) -> str:
        name, mode = f"data-{uuid.uuid4().hex}", "errorifexists"
        for rows in passes:
            _write_run(rows, f"{root}/{name}", max_rows_per_file, lookup, mode)
            mode = "append"
        return name

    # The filter is a fixed cost, which small runs are not worth.
    runs.append(written(in_passes(batch, "id", latest) if staged else [latest(batch)], lookup=not runs))
    if len(runs) > 1 and sum(_bytes(spark, root, run) for run in runs[1:]) * 2 >= _bytes(spark, root, runs[0]) > LEAST_BYTES:
        runs = [written([_merged(spark, root, runs)], lookup=True)]
    elif len(runs) > MOST_RUNS:
        runs = [runs[0], written([_merged(spark, root, runs[1:])])]
    _publish(spark, root, version + 1, "\n".join(runs))
    return version + 1


def append_records(records: DataFrame, root: str, protection: Protection | None, batch: str) -> bool:
    """Append a batch of identity records below ``root``; there is no key, so repeats in different batches accumulate.

    A batch counts once, however often it is appended: its rows go to a new folder, which counts when the batch's pointer
    is created, and that is never replaced. Returns whether this call is the one that counts.
    """
    spark = records.sparkSession
    pointer, fs = _folder(spark, root, f"batch-{hashlib.sha256(batch.encode()).hexdigest()}")
    if fs.exists(pointer):
        return False
    data = f"data-{uuid.uuid4().hex}"
    rows = _protected(records, protection, "records")
    clean = rows.select(*[F.col(f"`{c}`").alias(c.replace(" ", "_")) for c in rows.columns])
    clean.write.mode("errorifexists").parquet(f"{root}/{data}")
    try:
        out = fs.create(pointer, False)
    except Exception:
        if not fs.exists(pointer):
            raise
        path, _ = _folder(spark, root, data)  # a writer of the same batch was faster
        fs.delete(path, True)
        return False
    out.writeBytes(data)
    out.close()
    return True


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """The records of all batches that count. What a run that died has left is not read."""
    pointers = spark.read.text(f"{root}/batch-*").select(F.col("value")).collect()  # a line per batch
    return spark.read.parquet(*[f"{root}/{r['value']}" for r in pointers])


def register_sources(submissions: DataFrame, now: Column) -> DataFrame:
    """Clean leak-source submissions: trimmed text, ``discovered`` defaulting to now, integer id."""
    text = {name: strip(F.coalesce(F.col(name), F.lit(""))) for name in fv.SOURCE_FIELDS if name not in ("indexed", "id")}
    text["discovered"] = F.coalesce(F.nullif(text["discovered"], F.lit("")), now)
    text["indexed"] = now
    text["id"] = parse_int(F.coalesce(F.col("id"), F.lit("")))
    return submissions.select(*[text[name].alias(name) for name in fv.SOURCE_FIELDS])
