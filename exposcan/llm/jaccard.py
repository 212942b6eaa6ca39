"""Groups of documents whose word shingles overlap by a Jaccard similarity of 0.8 or more.

Parity sketches: every shingle of a document goes to one of ``k`` chunks, and a chunk is the XOR of
the hashes of its shingles. A shingle that only one of two documents has changes one chunk, so the
number of chunks that differ (their Hamming distance) is at most the symmetric difference ``d``
of the two sets. For similar sets of sizes a and b, ``d <= (a + b) / 9``.

Pigeonhole: if a document has more than ``d`` chunks that hold something, one of its first ``d + 1``
is the same in the other document, and stands among the other's first ``d + 1`` too: what comes
before the first unchanged chunk has changed. So each document is filed under its first ``t + 1``
chunks that hold something, where ``t`` bounds ``d`` for every size its partner can have, and
similar documents share a key. ``k`` depends on the size band. A document near the lower end of a band
is filed in the band below as well. A document with too few chunks that hold something is also filed
with more chunks, and at last shingle by shingle; a pair is safe once either document has enough.

Nothing is capped. Pairs sharing a key are first linked in a star per key. A pair whose bit sketches (the
parity of the shingles at each of some bits) differ in more places than similar sets can is dropped, the rest is verified
on the shingle hashes. Keys whose documents the links leave in different components are then taken up again. There documents are compared
by bit sketch until the likely pairs connect all that have one; of these pairs there are fewer than documents. Each group they
connect is then gathered once, and its sets are compared until they are joined: a pair is compared if its ends are in different
components so far, and only pairs that join two go out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from exposcan.llm.components import components
from exposcan.llm.hashing import mixed, run_hashes, word_hashes
from exposcan.llm.shared_keys import shared_keys
from exposcan.llm.storage import fresh, of_ids, settle

SHINGLE = 5
#: Similar: 100 * intersection >= 80 * union, that is 9 * difference <= sizes together.
PARTS = 9
#: Most shingles per chunk at the top of a size band.
FILL = 3.5
#: Bits of a bit sketch per shingle at the top of a size band.
BITS = 2
#: Documents of one key whose bit sketches are compared with each other at a time, and bytes of shingles of one group.
BLOCK = 4096
GROUP_BYTES = 32 << 20


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word runs; a shorter text is one run, none without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(run_hashes(word_hashes(words), min(size, len(words))))


def band_of(n: int) -> int:
    """Bands are [2^j, 2^(j+1))."""
    return n.bit_length() - 1


def filings(n: int) -> list[tuple[int, int]]:
    """(band, bound on the difference) under which a set of ``n`` shingles is filed."""
    band, found = band_of(n), []
    own = (n + n * 5 // 4) // PARTS
    if own:
        found.append((band, own))
    below = (1 << band) - 1
    if 5 * below >= 4 * n and (n + below) // PARTS:
        found.append((band - 1, (n + below) // PARTS))
    return found


def chunk_keys(tokens: np.ndarray, band: int, bound: int) -> list[np.ndarray]:
    """Keys of the first ``bound + 1`` chunks that hold something, at as many levels as it needs."""
    chunks, out = int((2 << band) / FILL) + 1, []
    for level in range(4):
        if level == 3:
            order, starts, parity = None, np.arange(len(tokens)), tokens
            place = np.zeros(len(tokens), np.uint64)
        else:
            at = tokens % np.uint64(chunks * 8**level)
            order = np.argsort(at, kind="stable")
            at = at[order]
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            parity = np.bitwise_xor.reduceat(tokens[order], starts)
            place = at[starts]
        keys = mixed(parity + mixed(place * np.uint64(256) + np.uint64(band * 4 + level)))
        out.append(keys[:bound + 1] & ~np.uint64(63) | np.uint64(band))
        if len(keys) > bound:
            break
    return out


def bit_sketch(tokens: np.ndarray, band: int) -> np.ndarray:
    """Parity of the shingles at each of BITS * 2^(band + 1) bits, as 64-bit words."""
    bits = max(64, BITS * (2 << band))
    counts = np.bincount((mixed(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8)).view(np.uint64)


def _filed(size: int):
    def run(batches):
        for batch in batches:
            counts, classes, keys, bands, sketches = [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()):
                tokens = shingles(text.as_py(), size)
                counts.append(len(tokens))
                classes.append(xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                filed = filings(len(tokens)) if len(tokens) else []
                found = [k for band, bound in filed for k in chunk_keys(tokens, band, bound)]
                bands.append([band for band, _ in filed])
                sketches.append([bit_sketch(tokens, band).tobytes() for band, _ in filed])
                keys.append(np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(classes, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *keys]))),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.binary())),
                ],
                names=["doc_id", "n_shingles", "class", "keys", "bands", "sketches"],
            )

    return run


def _tokens(size: int):
    def run(batches):
        for batch in batches:
            sets = [shingles(t.as_py(), size) for t in batch.column("text").cast(pa.binary())]
            classes = [xxh3_128_digest(tokens.tobytes()) for tokens in sets]
            arrays = [batch.column("doc_id"), pa.array(classes, pa.binary()), pa.array([tokens.view(np.int64) for tokens in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "class", "tokens"])

    return run


def _likely(batches):
    """Pairs whose bit sketches differ in no more places than similar sets can."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
        distance = np.array(
            [np.bitwise_count(np.frombuffer(x.as_py(), np.uint64) ^ np.frombuffer(y.as_py(), np.uint64)).sum() for x, y in zip(batch.column("one"), batch.column("other"))],
            np.int64,
        )
        yield batch.select(["a", "b"]).filter(pa.array(PARTS * distance <= na + nb))


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """The documents (a, b) of those pairs of classes whose sets are similar."""
    nodes = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    nodes = settle(reps.select("rep", "doc", "class").join(nodes, "rep"), "nodes")
    texts = of_ids(docs, nodes.select(F.col("doc").alias("doc_id")).distinct())
    sets = settle(texts.mapInArrow(_tokens(size), "doc_id long, class binary, tokens array<long>"), "sets")

    def similar(batches):
        for batch in batches:
            one, other, keep = batch.column("one"), batch.column("other"), []
            for at in range(batch.num_rows):
                x, y = (np.asarray(c[at].values) for c in (one, other))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 80 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in ("a", "b"):
        pairs = pairs.join(nodes.toDF(side, f"{side}_doc", f"{side}_class"), side)
    joined = pairs.join(sets.toDF("a_doc", "a_class", "one"), ["a_doc", "a_class"]).join(sets.toDF("b_doc", "b_class", "other"), ["b_doc", "b_class"])
    return joined.select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"), "one", "other").mapInArrow(similar, "a long, b long")


def _forest(rep, n, comp, part, sketch, one_block):
    """Pairs of different components, of fitting sizes, that the bit sketches allow: enough of them to connect all that have one.

    The rows of one key and one or two blocks by size: each is compared with the larger ones of
    fitting size, in two blocks only across the blocks. Rows that pairs have connected are not compared again, so there
    are fewer pairs than rows.
    """
    ends = np.searchsorted(n, n * 5 // 4, side="right")
    root, found = np.arange(len(n)), []
    for at in range(len(n) - 1):
        rest = slice(at + 1, ends[at])
        fits = (comp[rest] != comp[at]) & (root[rest] != root[at])
        if not one_block:
            fits &= part[rest] != part[at]
        to = at + 1 + np.flatnonzero(fits)
        if len(to):
            distance = np.bitwise_count(sketch[to] ^ sketch[at]).sum(axis=1, dtype=np.int64)
            to = to[PARTS * distance <= n[to] + n[at]]
            others, first = np.unique(root[to], return_index=True)
            found.append((np.full(len(first), rep[at]), rep[to[first]]))
            root[np.isin(root, others)] = root[at]
    return found


def _links(doc, n, comp, part, tokens, one_block):
    """Pairs whose sets are similar: as many as it takes to join the components that have such a pair.

    The rows of one group and one or two blocks by size, as in ``_forest``. Bit sketches of the group's own size choose
    the pairs whose sets are compared.
    """
    bits = 64 * max(1, -(-8 * int(n.max()) // 64))
    sketch = np.empty((len(n), bits // 64), np.uint64)
    for at, held in enumerate(tokens):
        counts = np.bincount((mixed(held) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        sketch[at] = np.packbits(counts.astype(np.uint8)).view(np.uint64)
    ends = np.searchsorted(n, n * 5 // 4, side="right")
    root, found = np.unique(comp, return_inverse=True)[1], []
    for at in range(len(n) - 1):
        rest = slice(at + 1, ends[at])
        fits = root[rest] != root[at]
        if not one_block:
            fits &= part[rest] != part[at]
        to = at + 1 + np.flatnonzero(fits)
        distance = np.bitwise_count(sketch[to] ^ sketch[at]).sum(axis=1, dtype=np.int64)
        for k in to[PARTS * distance <= n[to] + n[at]].tolist():
            if root[k] != root[at]:
                both = len(np.intersect1d(tokens[at], tokens[k], assume_unique=True))
                if 100 * both >= 80 * (n[at] + n[k] - both):
                    found.append((np.array([doc[at]]), np.array([doc[k]])))
                    root[root == root[k]] = root[at]
    return found


def _in_groups(group: str, node: str, held_as: str, read, pairs_of):
    """Batches sorted by group, blocks and size; the last group of a batch may go on in the next."""

    def pairs(table, ends):
        key, low, high = (table.column(c).to_numpy() for c in (group, "low", "high"))
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]) if len(key) else []
        columns = [table.column(c).to_numpy() for c in (node, "n_shingles", "component", "part")]
        held, found = table.column(held_as).combine_chunks(), []
        last = len(starts) if ends else len(starts) - 1
        for k in range(last):
            rows = slice(starts[k], starts[k + 1] if k + 1 < len(starts) else len(key))
            found += pairs_of(*(c[rows] for c in columns), read(held[rows]), low[rows.start] == high[rows.start])
        a, b = (np.concatenate([np.empty(0, np.int64), *(x[side] for x in found)]) for side in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]), table.slice(starts[-1] if len(starts) else 0)

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            out, held = pairs(pa.concat_tables([held, table]) if held is not None else table, False)
            yield out
        if held is not None:
            yield pairs(held, True)[0]

    return run


_compared = _in_groups("key", "rep", "sketch", lambda held: np.frombuffer(b"".join(held.to_pylist()), np.uint64).reshape(len(held), -1), _forest)
_linked = _in_groups("group", "doc", "tokens", lambda held: [np.asarray(x.values).view(np.uint64) for x in held], _links)


def _in_blocks(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each row once per block of its group, so that every two blocks meet; sorted as ``_in_groups`` wants it."""
    part = F.pmod(F.xxhash64("rep"), F.col(blocks)).cast("int")
    dealt = (
        rows.withColumn("part", part)
        .withColumn("to", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        .withColumn("low", F.least("part", "to"))
        .withColumn("high", F.greatest("part", "to"))
    )
    return dealt.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high", "n_shingles", "rep")


def near_duplicate_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs`` (doc_id, text).

    Texts are lower-cased in A-Z and cut at blanks, tabs and line ends. Null and empty texts have no
    shingles and are linked with nothing. Rows with equal sets form a class at once; only
    one row of a class takes part in the search. Rows that repeat a
    doc_id count as one document with several texts, each searched for itself, and share its component. A row with a null doc_id is linked
    with nothing and has a null component. Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    filed = docs.mapInArrow(_filed(size), "doc_id long, n_shingles long, class binary, keys array<long>, bands array<long>, sketches array<binary>").withColumn("row", F.monotonically_increasing_id())
    filed = settle(filed, "filed")
    known = filed.filter("doc_id is not null and class is not null")
    # A class goes by the number of a row, as an id may have texts of several classes.
    reps = known.groupBy("class").agg(F.min("row").alias("rep"), F.min("doc_id").alias("doc"), F.min("n_shingles").alias("n_shingles"))
    reps = settle(reps, "reps")
    member = settle(known.select("row", "doc_id", "class").join(reps, "class").select("row", "doc_id", "rep", "doc", "n_shingles"), "member")

    rows = known.select("row", F.explode("keys").alias("key"))
    found = shared_keys(rows, "key", "row").join(member, "row")
    found = settle(found.select("key", "rep", "n_shingles").distinct(), "shared")

    zipped = known.select("row", F.explode(F.arrays_zip("bands", "sketches")).alias("s"))
    bits = zipped.select(F.col("row").alias("rep"), F.col("s.bands").alias("band"), F.col("s.sketches").alias("sketch"))

    star = found.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("last"), F.min_by("n_shingles", "rep").alias("na"))
    fits = (F.col("rep") > F.col("a")) & (5 * F.least("na", "n_shingles") >= 4 * F.greatest("na", "n_shingles"))
    pairs = found.join(star.filter("a < last"), "key").filter(fits)
    pairs = pairs.groupBy("a", F.col("rep").alias("b")).agg(F.min(F.col("key").bitwiseAND(F.lit(63))).alias("band"), F.min("na").alias("na"), F.min("n_shingles").alias("nb"))
    pairs = settle(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("rep"), "band").union(pairs.select("b", "band")).distinct()
    some = settle(bits.join(wanted, ["rep", "band"], "left_semi").select("rep", "band", "sketch"), "bits")
    sketched = pairs.join(some.toDF("a", "band", "one"), ["a", "band"]).join(some.toDF("b", "band", "other"), ["b", "band"])
    likely = settle(sketched.select("a", "b", "na", "nb", "one", "other").mapInArrow(_likely, "a long, b long"), "likely")
    same = member.filter("doc_id != doc").select(F.col("doc").alias("a"), F.col("doc_id").alias("b")).distinct()
    label = components(_verified(likely, docs, reps, size).union(same))

    more = _second_pass(docs, found, bits, reps, label, size)
    if not more.isEmpty():
        label = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return (
        filed.select("doc_id", "n_shingles")
        .join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def _second_pass(docs: DataFrame, found: DataFrame, bits: DataFrame, reps: DataFrame, first: DataFrame, size: int) -> DataFrame:
    """Links between documents with classes that share a key but are in different components so far."""
    label = reps.select("rep", "doc").join(first.withColumnRenamed("node", "doc"), "doc", "left").select("rep", F.coalesce("component", "doc").alias("component"))
    labelled = found.join(label, "rep")
    per_key = labelled.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n"),
        F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("print_1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("print_2"),
    )
    # Two documents need no second look, and keys of equal documents need one look together.
    open_keys = (
        per_key.filter("least < most and n > 2")
        .groupBy("n", "print_1", "print_2", F.col("key").bitwiseAND(F.lit(63)).alias("band"))
        .agg(F.min("key").alias("key"))
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    )
    left = settle(labelled.join(open_keys.select("key", "band", "blocks"), "key"), "open")
    wanted = left.select("rep", "band").distinct()
    bits = settle(bits.join(wanted, ["rep", "band"], "left_semi").select("rep", "band", "sketch"), "bits")
    sketched = _in_blocks(left.join(bits, ["rep", "band"]), "key", "blocks")
    likely = settle(sketched.select("key", "rep", "n_shingles", "component", "part", "low", "high", "sketch").mapInArrow(_compared, "a long, b long").distinct(), "second")
    if likely.isEmpty():
        return likely
    # Every likely pair lies in one of the groups these pairs connect, so a group's sets are compared once, whatever keys they share.
    nodes = components(likely).withColumnsRenamed({"node": "rep", "component": "group"})
    nodes = nodes.join(reps, "rep").join(label, "rep")
    sizes = nodes.groupBy("group").agg(F.ceil(8 * F.sum("n_shingles") / GROUP_BYTES).cast("int").alias("blocks"))
    nodes = settle(nodes.join(sizes, "group"), "nodes")
    texts = of_ids(docs, nodes.select(F.col("doc").alias("doc_id")).distinct())
    sets = texts.mapInArrow(_tokens(size), "doc_id long, class binary, tokens array<long>").dropDuplicates(["doc_id", "class"])
    held = settle(nodes.join(sets.withColumnRenamed("doc_id", "doc"), ["doc", "class"]), "sets")
    linked = _in_blocks(held, "group", "blocks").select("group", "doc", "n_shingles", "component", "part", "low", "high", "tokens")
    return settle(linked.mapInArrow(_linked, "a long, b long"), "links")


def one_of_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is the smallest of its component.

    Rows that repeat such a doc_id all stay, and so do rows with a null doc_id.
    """
    groups = near_duplicate_groups(docs, size)
    key = fresh("_id", docs.columns)
    gone = settle(groups.filter("component_id != doc_id").select(F.col("doc_id").alias(key)).distinct(), "gone")
    return of_ids(docs.withColumn(key, F.col("doc_id").cast("long")), gone, "left_anti", key).drop(key)
