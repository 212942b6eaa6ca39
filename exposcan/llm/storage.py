"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids up to this number may be broadcast (8 MB of longs); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a folder of our own only for local runs."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="exposcan-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _free_shuffles(spark: SparkSession) -> None:
    """Let go of what earlier steps hold on disk: shuffle files stay until the driver collects their owners."""
    for _ in range(2):  # the second round collects what the first has released
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    _trim(spark)


def _trim(spark: SparkSession) -> str | None:
    """Give the driver's freed native memory back: the C library keeps what the compiler and the codecs of earlier steps have freed.

    What the JVM says of it; null where it has no such command (it came with 17.0.9, for Linux).
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    args = array(jvm.java.lang.Object, 4)
    args[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    args[1], args[2], args[3] = "systemTrimNativeHeap", array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    try:
        return invoke.invoke(server, args)
    except Py4JJavaError:
        return None


def settle(frame: DataFrame, label: str, free: bool = True) -> DataFrame:
    """Write ``frame`` as a table in the shared folder and read it back.

    This cuts the lineage, so a lost executor costs the running tasks only, and the shuffles of the
    steps before go: there is one step's on disk at a time. Without ``free`` they stay, which is quicker after small steps.
    """
    spark = frame.sparkSession
    if free:
        _free_shuffles(spark)
    path = f"{shared_folder(spark)}/exposcan-llm/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop(settled: DataFrame) -> None:
    """Delete a table that ``settle`` wrote; nothing lazy may need it any more."""
    spark = settled.sparkSession
    for file in settled.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "/exposcan-llm/" in path.toString():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or the like of it, for a column beside ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def of_ids(rows: DataFrame, ids: DataFrame, how: str = "left_semi", key: str = "doc_id") -> DataFrame:
    """Rows whose key is among ``ids``, or with ``left_anti`` is not.

    Few ids go to every task, so that texts stay where they are; more are joined by a shuffle.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, how)
