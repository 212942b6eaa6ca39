"""Intermediate results that several branches of a plan read."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Scans of more bytes are left alone, however few their splits are.
SPREAD_BYTES = 2 << 30
#: Bytes of an extract that are shuffled at once; more go in passes, up to ``MOST_PASSES``.
PASS_BYTES = 256 << 20
MOST_PASSES = 8
_dropped: list[list[str]] = []


def _shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of our own only for local runs."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="exposcan-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def free_shuffles(spark: SparkSession) -> None:
    """Let go of what earlier steps hold on disk: shuffle files stay until the driver collects their owners."""
    for _ in range(2):  # the second round collects what the first has released
        gc.collect()
        spark.sparkContext._jvm.System.gc()


@contextmanager
def dropping(spark: SparkSession):
    """Extracts that are materialised inside are deleted at the end, with what is left of their shuffles."""
    _dropped.append(paths := [])
    try:
        yield
    finally:
        _dropped.remove(paths)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        free_shuffles(spark)


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a small scan so that every core gets some.

    A few large row groups would leave cores idle during extraction. Scans with several splits
    per core, and all of more than ``SPREAD_BYTES``, are left alone: their texts are never shuffled. For
    plain scans only, as counting the splits of a shuffled plan would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if _bytes(scan) > SPREAD_BYTES:
        return scan
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < 4 * cores else scan


@contextmanager
def many_files(spark: SparkSession):
    """For folders of very many small files: listed in some tasks per core, not one per folder, and read by hundreds in a task, not by a few."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    wanted = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks), "spark.sql.files.openCostInBytes": str(256 << 10)}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def with_once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that they are computed once per row.

    The optimizer copies a plain column into every filter and projection that mentions it; it
    does not reach through a generator.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return frame.select("*", F.explode(F.array(values)).alias("_once")).select(
        *frame.columns, *[f"_once.{name}" for name in columns]
    )


def _bytes(frame: DataFrame) -> int:
    """What the engine takes for the size of ``frame``; that of the files for a scan."""
    return frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def _extract(spark: SparkSession) -> str:
    path = f"{_shared_folder(spark)}/exposcan-extracts/{uuid.uuid4().hex}"
    for paths in _dropped[-1:]:
        paths.append(path)
    return path


def write_compressed(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    frame.write.mode(mode).option("compression", "zstd").parquet(path)


def materialise(small: DataFrame) -> DataFrame:
    """Write an extract once so that its input is scanned once, however many branches use it.

    For extracts only: findings and verdicts, never the texts they come from. The copy is a compressed table
    in shared storage and survives the loss of executors; inside ``dropping`` it goes when that ends.
    """
    spark = small.sparkSession
    write_compressed(small, path := _extract(spark))
    return spark.read.schema(small.schema).parquet(path)


def materialise_all(spark: SparkSession, frames: Iterable[DataFrame]) -> DataFrame:
    """One extract of several frames of one schema, written one after the other; what an iterator materialises for a frame goes with it."""
    path, left, schema = _extract(spark), iter(frames), None
    while True:
        with dropping(spark):
            if (frame := next(left, None)) is None:
                return spark.read.schema(schema).parquet(path)
            schema = frame.schema
            write_compressed(frame, path, "append")
            del frame


def in_passes(extract: DataFrame, key: str, step: Callable[[DataFrame], DataFrame]) -> Iterator[DataFrame]:
    """``step`` of all rows of a materialised extract, or of a large one part by part, so that the shuffles of one part are on disk at a time.

    Rows of one ``key`` are in one part. Each result has to be written before the next one is asked for.
    """
    parts = min(MOST_PASSES, 1 + _bytes(extract) // PASS_BYTES)
    for part in range(parts):
        yield step(extract if parts == 1 else extract.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part))
        if parts > 1:
            free_shuffles(extract.sparkSession)


def by_passes(extract: DataFrame, key: str, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same as one table, which is written only if there are several parts."""
    passes = in_passes(extract, key, step)
    first = next(passes)
    if _bytes(extract) < PASS_BYTES:
        return first
    spark, schema = extract.sparkSession, first.schema
    write_compressed(first, path := _extract(spark))
    for more in passes:
        write_compressed(more, path, "append")
    return spark.read.schema(schema).parquet(path)
