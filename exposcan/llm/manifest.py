"""Merkle manifest of a dataset: a proof for every row that it belongs to one root digest.

The rows of a group are the leaves of a tree of ``FAN`` children a node; the roots of these trees, in the order of the
groups, are the leaves of one tree above. A tree is built level by level, each by one aggregate
over runs of ``FAN`` consecutive nodes.

Pointer jumping: every inner node starts with the segment of its own level (the digests left and right of
it in its run) and a pointer to its parent. A self-join appends to each node's segment that of the node
it points at and takes over its pointer, so the distance doubles: after ``log2`` of the height every node holds the
siblings of its whole way to the root. The leaves of a run have the same parent, so they make their one
jump together, as one row, when the inner nodes are done.

Numbers: a leaf moves as one row of about 200 bytes, inner nodes are a fifteenth of the leaves. No step
holds more than one run, and no digest but the root reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan.llm.places import placed
from exposcan.llm.storage import settle

FAN = 16
#: Columns that make up a leaf.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A tree has its number times this, plus the level, as the place of its nodes; no tree is as high.
HEIGHT = 64

_EMPTY = "cast(array() as array<struct<left: string, right: string, subroot: string>>)"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256, in hex, of the values: ``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def _runs(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Runs of consecutive nodes (tree, idx, n, ...) as rows: ``run`` is their number, ``members`` are in order."""
    members = F.sort_array(F.collect_list(F.struct("idx", *carried))).alias("members")
    return nodes.groupBy("tree", F.expr(f"idx div {FAN}").alias("run")).agg(F.first("n").alias("n"), members)


def _joined(members: Column, digest: str) -> Column:
    return F.array_join(F.transform(members, lambda m: m[digest]), "")


def _above(runs: DataFrame, digest: str) -> DataFrame:
    """The parents of runs, as nodes of the next level."""
    return runs.filter("n > 1").select("tree", F.col("run").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.sha2(_joined(F.col("members"), digest), 256).alias("digest"))


def _beside(members: Column, at: Column, digest: str) -> tuple[Column, Column]:
    """Digests of a run, joined: those before the member of number ``at``, and those after it."""
    return _joined(F.slice(members, 1, at), digest), _joined(F.slice(members, at + 2, F.lit(FAN)), digest)


def _pointer(tree: Column, level: int, run: Column, parents: Column) -> tuple[Column, Column]:
    """Where the members of a run point: at their parent, or beyond the last level at the tree above; the root is null."""
    inner = parents > 1
    place = F.when(inner, tree * HEIGHT + level + 1).when(tree > 0, F.lit(0).cast("long"))
    return place, F.when(inner, run).when(tree > 0, tree - 1)


def _segments(runs: DataFrame, level: int) -> DataFrame:
    """The members of runs of one level as nodes with their segment and pointer."""
    parents = F.expr(f"(n + {FAN - 1}) div {FAN}")
    rows = runs.select("tree", "run", "n", "members", F.posexplode("members").alias("at", "node"))
    left, right = _beside(F.col("members"), F.col("at"), "digest")
    none = F.lit(None).cast("string")
    own = F.struct(left.alias("left"), right.alias("right"), none.alias("subroot"))
    # A node of the lowest level of the upper tree is the root of a tree below.
    below = F.struct(none.alias("left"), none.alias("right"), F.col("node.digest").alias("subroot"))
    segment = F.when(F.col("n") > 1, F.array(own)).otherwise(F.expr(_EMPTY))
    if level == 0:
        segment = F.concat(F.array(below), segment)
    up = _pointer(F.col("tree"), level, F.col("run"), F.when(F.col("n") > 1, parents).otherwise(F.lit(1)))
    return rows.select((F.col("tree") * HEIGHT + level).alias("place"), F.col("node.idx").alias("idx"), up[0].alias("up_place"), up[1].alias("up_idx"), segment.alias("segment"))


def _tree(nodes: DataFrame, most: int, level: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels from ``nodes`` upwards: the segments of all nodes but roots, and the roots (tree, digest).

    ``most`` is the number of nodes of the widest tree; trees with one node have their root there.
    """
    segments, roots = [], []
    while True:
        roots.append(nodes.filter("n = 1").select("tree", "digest"))
        if most <= 1:
            return segments, roots
        runs = settle(_runs(nodes.filter("n > 1"), ["digest"]), "runs", free=False)
        segments.append(_segments(runs, level))
        nodes, most, level = settle(_above(runs, "digest"), "nodes", free=False), -(-most // FAN), level + 1


def jumped(links: DataFrame) -> DataFrame:
    """Nodes (place, idx, up_place, up_idx, segment) with the segments of their whole way up.

    A join on a pointer many nodes share is split by Spark's handling of skew: the nodes are on its left side.
    """
    while not links.filter("up_place is not null").isEmpty():
        far = links.select(F.col("place").alias("up_place"), F.col("idx").alias("up_idx"), F.col("up_place").alias("next_place"), F.col("up_idx").alias("next_idx"), F.col("segment").alias("rest"))
        both = links.join(far, ["up_place", "up_idx"], "left")
        links = settle(both.select("place", "idx", F.col("next_place").alias("up_place"), F.col("next_idx").alias("up_idx"), F.concat("segment", F.coalesce("rest", F.expr(_EMPTY))).alias("segment")), "jumped", free=False)
    return links


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", key: str = "doc_id", found: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root`` and ``verified``.

    Leaves are ordered by group (null first, then bytewise), key (null first) and digest. ``proof`` holds the joined digests of the siblings,
    level by level from left to right. ``found`` gives columns as they stand when the proof is checked: the leaf is
    made of them and folded with the siblings of the manifest, and ``verified`` tells whether that gives the root.

    Rows that repeat a key, or are equal throughout, are leaves of their own. Null and empty values differ (``-`` and ``0:``). Without
    rows there is no root and the result is empty. Other columns of ``docs`` are ignored.
    """
    now = leaf_digest([(found or {}).get(c, F.col(c)) for c in columns])
    tree_of = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(tree_of.alias("group"), F.col(key).cast("long").alias("doc_id"), leaf_digest([F.col(c) for c in columns]).alias("digest"), now.alias("found"))
    # Of rows as they were the second digest is not kept: most are.
    leaves = leaves.select("group", "doc_id", "digest", F.nullif("found", "digest").alias("found"), F.monotonically_increasing_id().alias("row"))
    leaves = settle(leaves, "leaves")

    sizes = settle(leaves.groupBy("group").agg(F.count("*").alias("n")), "sizes", free=False)
    trees, most = sizes.agg(F.count("*"), F.max("n")).first()
    result = "doc_id long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"
    if not trees:
        return docs.sparkSession.createDataFrame([], result)
    numbered = placed(sizes.withColumn("all", F.lit(0)), "all", ["group"])
    numbered = numbered.select("group", "n", (F.col("idx") + 1).alias("tree"))
    ordered = placed(leaves, "group", ["doc_id", "digest", "row"], numbered)
    lowest = settle(_runs(ordered, ["doc_id", "digest", "found"]), "lowest")

    lone = lowest.filter("n = 1").select("tree", F.get("members", F.lit(0))["digest"].alias("digest"))
    segments, roots = [], [lone]
    if most > 1:
        segments, found_roots = _tree(settle(_above(lowest, "digest"), "nodes", free=False), -(-most // FAN), 1)
        roots += found_roots
    subroots = reduce(DataFrame.union, roots).select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(trees).cast("long").alias("n"), "digest")
    subroots = settle(subroots, "subroots", free=False)
    upper, top = _tree(subroots, trees, 0)
    # A single subroot is the root: it has no run, but leaves look it up all the same.
    upper = upper or [_segments(_runs(subroots, ["digest"]), 0)]
    root = reduce(DataFrame.union, top).first()["digest"]
    paths = jumped(settle(reduce(DataFrame.union, [*segments, *upper]), "links"))

    place, idx = _pointer(F.col("tree"), 0, F.col("run"), F.expr(f"(n + {FAN - 1}) div {FAN}"))
    bundles = lowest.withColumns({"place": place, "up": idx}).join(paths.select("place", F.col("idx").alias("up"), F.col("segment").alias("path")), ["place", "up"])
    rows = bundles.select("n", "members", "path", F.posexplode("members").alias("at", "node"))
    left, right = _beside(F.col("members"), F.col("at"), "digest")
    rows = rows.select("n", "path", "node", left.alias("left"), right.alias("right"))
    first = F.coalesce("node.found", "node.digest")
    start = F.when(F.col("n") > 1, F.sha2(F.concat("left", first, "right"), 256)).otherwise(first)
    folded = F.aggregate("path", start, lambda acc, e: F.when(e["left"].isNull(), acc).otherwise(F.sha2(F.concat(e["left"], acc, e["right"]), 256)))
    beside = F.array_join(F.transform("path", lambda e: F.coalesce(F.concat(e["left"], e["right"]), F.lit(""))), "")
    rows = rows.select(
        F.col("node.doc_id").alias("doc_id"), F.col("node.digest").alias("leaf"),
        F.get(F.filter("path", lambda e: e["subroot"].isNotNull()), F.lit(0))["subroot"].alias("subroot"),
        F.lit(root).alias("root"), F.concat("left", "right", beside).alias("proof"), folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_cased(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
