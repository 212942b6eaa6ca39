"""Nearest neighbours by inner product over learned partitions.

A bounded sample of vectors is joined to its nearest neighbours, and this graph is cut into balanced parts: parts
start from a random assignment of equal sizes and vectors move to the part most of their neighbours are in,
as long as it has room. A softmax classifier learns the part from the vector. Every vector is filed under its likeliest
part; a query is sent to its several likeliest parts, and there all vectors are ranked exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from exposcan.llm.storage import settle

#: Vectors the partition is learnt from; and neighbours of each in the graph.
SAMPLE = 8_000
NEIGHBOURS = 16
#: Vectors of the sample per part, at least, and most parts.
PART = 400
MOST_PARTS = 256
#: Share of the parts a query is sent to.
PROBED = 0.75
#: Rows of a part ranked together.
CANDIDATES, QUERIES = 4_096, 1_024


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def balanced_parts(vectors: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Part of each vector: neighbours together, no part over a tenth above the mean."""
    random = np.random.default_rng(seed)
    n = len(vectors)
    near = np.empty((n, min(NEIGHBOURS, n - 1)), np.int64)
    for at in range(0, n, 1024):
        score = vectors[at:at + 1024] @ vectors.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        near[at:at + 1024] = np.argpartition(-score, near.shape[1] - 1, axis=1)[:, :near.shape[1]]
    # The first parts are the seeds' neighbourhoods, filled evenly.
    room = int(np.ceil(1.1 * n / parts))
    heads = vectors[random.choice(n, parts, replace=False)]
    closeness = vectors @ heads.T
    part, size = np.full(n, -1), np.zeros(parts, np.int64)
    for v in np.argsort(-(closeness.max(axis=1))):
        for p in np.argsort(-closeness[v]):
            if size[p] < room:
                part[v], size[p] = p, size[p] + 1
                break
    source = np.repeat(np.arange(n), near.shape[1])
    ends = near.ravel()
    for _ in range(12):
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (source, part[ends]), 1)
        np.add.at(votes, (ends, part[source]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        moved = 0
        for v in np.argsort(-gain):
            if gain[v] <= 0:
                break
            if size[best[v]] < room:
                size[part[v]] -= 1
                size[best[v]] += 1
                part[v], moved = best[v], moved + 1
        if not moved:
            break
    return part


def train_router(vectors: np.ndarray, part: np.ndarray, parts: int, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights and intercepts of a softmax classifier of the part, by gradient descent with momentum."""
    w, b = np.zeros((vectors.shape[1], parts)), np.zeros(parts)
    dw, db, truth = 0 * w, 0 * b, np.eye(parts)[part]
    scale = 1 / max(1e-12, float(np.mean(np.square(vectors).sum(axis=1))))
    for _ in range(rounds):
        z = vectors @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        slope = (p / p.sum(axis=1, keepdims=True) - truth) / len(vectors)
        dw = 0.9 * dw - 4.0 * parts * scale * (vectors.T @ slope)
        db = 0.9 * db - 0.5 * slope.sum(axis=0)
        w, b = w + dw, b + db
    return w, b


def _ranked(k: int):
    """Queries and candidates of one block: the k best of each query there."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(queries) or not len(candidates):
            return schema.empty_table()
        ids = candidates.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        width = len(candidates.column("vector")[0])
        matrix = candidates.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, width)[order]
        asked = queries.column("vec_id").to_numpy()
        asking = queries.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, width)
        out = []
        for q, vector in zip(asked, asking):
            # One product and sum per pair, in the same order everywhere, whatever the block.
            score = np.einsum("ij,j->i", matrix, vector)
            score[ids == q] = -np.inf
            most = min(k, len(ids))
            worst = np.partition(score, len(score) - most)[len(score) - most]
            kept = np.flatnonzero(score >= worst)
            kept = kept[np.argsort(-score[kept], kind="stable")][:most]
            kept = kept[score[kept] > -np.inf]
            out.append((np.full(len(kept), q), ids[kept], score[kept]))
        return pa.table([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], schema=schema)

    return run


def _routed(w: np.ndarray, b: np.ndarray, probes: int):
    def run(batches):
        for batch in batches:
            vectors = np.asarray(batch.column("vector").flatten()).reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, len(w)))
            likely = np.argsort(-(vectors @ w + b), axis=1, kind="stable")[:, :probes].astype(np.int32)
            ends = pa.array(np.arange(batch.num_rows + 1) * likely.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.ListArray.from_arrays(ends, pa.array(likely.ravel()))], names=["vec_id", "vector", "parts"]
            )

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found for each query.

    ``vectors`` has vec_id and embedding; every row but the query's own is a candidate. Null ids, null or
    zero vectors and those with null or non-finite components take no part, nor do vectors
    of another length than most of the sample. Equal scores are ranked by vec_id. Rows repeating an id
    and vector count once. Other columns are ignored. The sample is the SAMPLE usable vectors whose ids
    hash lowest; all rows are indexed.
    """
    kind = "vec_id long, vector array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    drawn = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    result = "query_id long, vec_id long, score double"
    if not drawn:
        empty = vectors.sparkSession.createDataFrame([], f"{result}, rank int")
        return empty.select("query_id", "rank", "vec_id", "score")
    lengths = [len(r["vector"]) for r in drawn]
    width = max(sorted(set(lengths)), key=lengths.count)
    sample = np.array([r["vector"] for r in drawn if len(r["vector"]) == width])
    # Equal vectors say nothing about how to cut.
    sample = np.unique(sample, axis=0)
    parts = max(1, min(MOST_PARTS, len(sample) // PART))
    probes = max(1, math.ceil(PROBED * parts))
    w, b = np.zeros((width, 1)), np.zeros(1)
    if parts > 1:
        w, b = train_router(sample, balanced_parts(sample, parts), parts)

    rows = rows.filter(F.size("vector") == width).dropDuplicates(["vec_id", "vector"])
    filed = rows.select("vec_id", "vector").mapInArrow(_routed(w, b, 1), f"{kind}, parts array<int>")
    filed = settle(filed.select("vec_id", "vector", F.col("parts")[0].alias("part")), "filed")
    asked = rows.filter("asks").select("vec_id", "vector").mapInArrow(_routed(w, b, probes), f"{kind}, parts array<int>")
    asked = settle(asked.select("vec_id", "vector", F.explode("parts").alias("part")), "asked")

    # Large parts are ranked block by block; there are at most MOST_PARTS sizes to broadcast.
    sizes = filed.groupBy("part").agg(F.ceil(F.count("*") / CANDIDATES).cast("int").alias("held")).join(
        asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("wanted")), "part"
    )
    sizes = F.broadcast(sizes)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = asked.join(sizes, "part").withColumn("block", own("wanted")).withColumn("held", every("held"))
    right = filed.join(sizes, "part").withColumn("held", own("held")).withColumn("block", every("wanted"))
    key = ["part", "held", "block"]
    best = left.select(*key, "vec_id", "vector").groupBy(*key).cogroup(right.select(*key, "vec_id", "vector").groupBy(*key)).applyInArrow(_ranked(k), result)
    # Of each query k rows a task go into the shuffle, whatever the number of blocks.
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
