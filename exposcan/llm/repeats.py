"""Removal of word passages that documents with smaller ids have too.

Repeated-phrase automata, in four steps:

Texts of the same words are told by a digest; all but that of the smallest id skip steps 1 and 2, and
their phrase is the whole of its text. Several texts of one id are numbered through as one document, with a gap.

1. *Anchors.* A window of 13 words holds six runs of 8 words; the run with the smallest hash is its
   anchor. Equal windows have equal anchors, so a window can only recur if its anchor
   does. Anchors (about two in seven) are sorted with their documents to find those that several have.
2. *Confirmed windows.* Only windows with such an anchor are hashed and counted. Each one that several
   documents hold gets the smallest of these as its origin.
3. *Phrases.* Windows of a document that follow each other as they do in their origin are one phrase.
   Documents are dealt to buckets of bounded text, and each bucket is given the phrases of its documents, as
   pieces of the text of the origin.
4. *Automata.* In each bucket the first windows of its phrases are compiled into Aho-Corasick automata
   over words, in shards of bounded size, and all its documents are streamed through them. From a hit on,
   words go as long as they are those of the phrase, and if the origin has a smaller id. So
   what goes is an equal word sequence, not an equal hash.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from exposcan.llm.hashing import run_hashes, word_hashes
from exposcan.llm.shared_keys import shared_keys
from exposcan.llm.storage import drop, fresh, of_ids, settle

WINDOW = 13
ANCHOR = 8
#: Windows of one piece of text.
PIECE = 64
#: Words of the documents of one bucket, about, if no document has more.
BUCKET_WORDS = 400_000
#: Start of a piece that is a whole text.
WHOLE = -1
#: Phrases of one automaton.
SHARD = 100_000


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _window_anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchor of every window: the smallest hash among its runs."""
    runs = run_hashes(hashes, ANCHOR)
    per_window = window - ANCHOR + 1
    if len(runs) < per_window:
        return np.empty(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(runs, per_window).min(axis=1)


def _texts(batch: pa.RecordBatch):
    return (t.as_py() for t in batch.column("text").cast(pa.binary()))


def _lists(values: list[np.ndarray], kind) -> pa.ListArray:
    flat = np.concatenate([np.empty(0, kind), *values]).astype(kind)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(flat))


def _anchored(window: int):
    def run(batches):
        for batch in batches:
            counts, digests, anchors = [], [], []
            for text in _texts(batch):
                words = words_of(text)
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                anchors.append(np.unique(_window_anchors(word_hashes(words), window)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), _lists(anchors, np.int64)],
                names=["doc_id", "n_words", "sha256", "anchors"],
            )

    return run


def _candidates(window: int):
    """Windows with a shared anchor, with the piece of text each lies in."""

    def run(batches):
        for batch in batches:
            columns = {k: [] for k in ("windows", "places", "starts", "piece_starts", "piece_texts")}
            counts = []
            for text, shared, offsets in zip(_texts(batch), batch.column("shared"), batch.column("offsets").to_pylist()):
                words = words_of(text)
                offset = dict(offsets)[hashlib.sha256(b" ".join(words)).hexdigest()] if offsets else 0
                hashes = word_hashes(words)
                at = np.flatnonzero(np.isin(_window_anchors(hashes, window), np.asarray(shared.values).view(np.uint64)))
                run_start = np.r_[True, np.diff(at) > 1][:len(at)]
                first = at[np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))] if len(at) else at
                starts = first + (at - first) // PIECE * PIECE
                own, last = np.unique(starts), np.r_[np.flatnonzero(np.diff(starts)), len(at) - 1] if len(at) else at
                columns["windows"].append(run_hashes(hashes, window)[at].view(np.int64))
                columns["places"].append(at + offset)
                columns["starts"].append(starts + offset)
                columns["piece_starts"].append(own + offset)
                columns["piece_texts"].append([b" ".join(words[a:at[z] + window]) for a, z in zip(own, last)])
                counts.append(len(words))
            arrays = [_lists(columns[k], kind) for k, kind in (("windows", np.int64), ("places", np.int32), ("starts", np.int32), ("piece_starts", np.int32))]
            texts = pa.array(columns["piece_texts"], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), *arrays, texts], names=["doc_id", "n_words", *columns])

    return run


def _located(window: int):
    """Documents and pieces of one bucket: what is left of the documents' words."""

    def run(docs: pa.Table, pieces: pa.Table) -> pa.Table:
        names: dict[bytes, int] = {}
        phrases: dict[tuple, dict[tuple, np.ndarray]] = {}  # by their first window, then by origin
        for first, start, text, runs, whole in zip(*(pieces.column(c).to_pylist() for c in ("first_doc", "start", "text", "runs", "sha256"))):
            ids = np.array([names.setdefault(w, len(names) + 1) for w in words_of(text.encode())], np.int32)
            for r in runs:
                at = r["place"] - max(start, 0)
                phrase = ids[at:at + r["length"] + window - 1]
                alike = phrases.setdefault(tuple(phrase[:window].tolist()), {})
                if len(alike.get((first, whole), ())) < len(phrase):
                    alike[first, whole] = phrase
        ids = docs.column("doc_id").to_pylist()
        words = [words_of(t.as_py()) for t in docs.column("text").cast(pa.binary())]
        known = [np.array([names.get(w, 0) for w in text], np.int32) for text in words]
        change = [np.zeros(len(w) + 1, np.int32) for w in words]
        heads = list(phrases)
        for at in range(0, len(heads), SHARD):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for head in heads[at:at + SHARD]:
                automaton.add_word(head, phrases[head])
            automaton.make_automaton()
            for doc, text, marks in zip(ids, known, change):
                if len(text) >= window:
                    for end, alike in automaton.iter(tuple(text.tolist())):
                        start = end - window + 1
                        for (first, _), phrase in alike.items():
                            if first < doc:
                                here = text[start:start + len(phrase)]
                                differs = np.flatnonzero(here != phrase[:len(here)])
                                marks[start] += 1
                                marks[start + (differs[0] if len(differs) else len(here))] -= 1
        removed, kept, before = [], [], []
        for text, marks in zip(words, change):
            gone = np.cumsum(marks[:-1]) > 0
            removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(text, gone.tolist()) if not g]))
            before.append(hashlib.sha256(b" ".join(text)).hexdigest())
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "sha256": pa.array(before, pa.string()), "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        })

    return run


def _digest():
    """What ``hashlib`` makes of the words of ``text``, joined by one blank."""
    return F.sha2(F.concat_ws(" ", F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")), 256)


def _offsets(base: DataFrame) -> DataFrame:
    """Ids with several texts: where the words of each are counted from (doc_id, map of sha256 to offset)."""
    ids = base.filter("doc_id is not null").groupBy("doc_id").agg(F.min("sha256").alias("least"), F.max("sha256").alias("most")).filter("least < most").select("doc_id")
    texts = of_ids(base, settle(ids, "several")).select("doc_id", "sha256", "n_words").distinct()
    before = W.partitionBy("doc_id").orderBy("sha256").rowsBetween(W.unboundedPreceding, -1)
    texts = texts.withColumn("offset", F.coalesce(F.sum(F.col("n_words") + 1).over(before), F.lit(0)))
    return texts.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("sha256", "offset"))).alias("offsets"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _found(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, n_words, sha256), and what is left of those that repeat others.

    The second table has one row per (doc_id, sha256) with ``n_removed`` > 0.
    """
    anchored = settle(docs.mapInArrow(_anchored(window), "doc_id long, n_words long, sha256 string, anchors array<long>"), "anchors")
    base = settle(anchored.select("doc_id", "n_words", "sha256"), "base")
    # Of documents with the same words only the one of the smallest id is searched for windows; the others
    # repeat all of it.
    first = base.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window)).groupBy("sha256").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last"))
    copies = base.join(first.filter("first_doc < last"), "sha256").filter("doc_id > first_doc").select("doc_id", "sha256", "first_doc", "n_words").distinct()
    copies = settle(copies, "copies")

    rows = of_ids(anchored.filter("doc_id is not null"), copies.select("doc_id", "sha256"), "left_anti", ["doc_id", "sha256"])
    rows = rows.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = settle(shared_keys(rows, "anchor", "doc_id").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared")), "shared")
    drop(anchored)
    offsets = settle(_offsets(base), "offsets")
    flagged = of_ids(docs, shared.select("doc_id")).join(shared.join(offsets, "doc_id", "left"), "doc_id")
    lists = "windows array<long>, places array<int>, starts array<int>, piece_starts array<int>, piece_texts array<string>"
    windows = settle(flagged.select("doc_id", "text", "shared", "offsets").mapInArrow(_candidates(window), f"doc_id long, n_words long, {lists}"), "windows")

    words = (windows.agg(F.sum("n_words")).first()[0] or 0) + (copies.agg(F.sum("n_words")).first()[0] or 0)
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(int(words // BUCKET_WORDS) + 1)).cast("int")
    zipped = F.explode(F.arrays_zip("windows", "places", "starts")).alias("w")
    # Place in the document and start of the piece as one number, which an aggregate can hold.
    both = (F.shiftleft(F.col("w.places").cast("long"), 32) + F.col("w.starts")).alias("both")
    held = windows.select("doc_id", zipped).select("doc_id", F.col("w.windows").alias("window"), F.col("w.places").alias("place"), both)
    origin = held.groupBy("window").agg(F.min("doc_id").alias("first_doc"), F.min_by("both", "doc_id").alias("both"), F.max("doc_id").alias("last"))
    origin = origin.filter("first_doc < last").select(
        "window", "first_doc", F.shiftright("both", 32).cast("int").alias("origin_place"), F.col("both").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("start")
    )
    repeated = held.select("window", "doc_id", "place").join(origin, "window").filter("doc_id > first_doc")
    repeated = repeated.select("doc_id", "place", "first_doc", "origin_place", "start").withColumn("shift", F.col("place") - F.col("origin_place"))
    in_doc = W.partitionBy("doc_id").orderBy("place")
    goes_on = F.lit(True)
    for column, step in (("place", 1), ("first_doc", 0), ("start", 0), ("shift", 0)):
        goes_on &= F.lag(column).over(in_doc) + step == F.col(column)
    runs = repeated.withColumns({"new": ~F.coalesce(goes_on, F.lit(False)), "at": F.row_number().over(in_doc), "n": F.count("*").over(W.partitionBy("doc_id"))})
    runs = runs.filter("new").withColumn("length", F.coalesce(F.lead("at").over(in_doc), F.col("n") + 1) - F.col("at"))
    runs = runs.select(bucket.alias("bucket"), "doc_id", "first_doc", "start", F.col("origin_place").alias("place"), F.col("length").cast("int").alias("length"))
    needs = runs.groupBy("bucket", "first_doc", "start").agg(F.collect_set(F.struct("place", "length")).alias("runs"), F.collect_set("doc_id").alias("in_docs"))
    needs = settle(needs, "needs")

    pieces = windows.select(F.col("doc_id").alias("first_doc"), F.explode(F.arrays_zip("piece_starts", "piece_texts")).alias("p"))
    pieces = pieces.select("first_doc", F.col("p.piece_starts").alias("start"), F.col("p.piece_texts").alias("text")).dropDuplicates(["first_doc", "start"])
    pieces = needs.drop("in_docs").join(pieces, ["first_doc", "start"]).select("bucket", "first_doc", "start", "text", "runs", F.lit(None).cast("string").alias("sha256"))
    whole = F.array(F.struct(F.lit(0).alias("place"), (F.col("n_words") - window + 1).cast("int").alias("length"))).alias("runs")
    wanted = copies.select(bucket.alias("bucket"), "first_doc", "sha256", F.lit(WHOLE).alias("start"), whole).distinct()
    texts = of_ids(docs, copies.select(F.col("first_doc").alias("doc_id")).distinct()).withColumnRenamed("doc_id", "first_doc").distinct()
    pieces = pieces.unionByName(wanted.join(texts.withColumn("sha256", _digest()), ["first_doc", "sha256"]))
    touched = needs.select(F.explode("in_docs").alias("doc_id")).union(copies.select("doc_id")).distinct()
    dealt = of_ids(docs, touched).withColumn("bucket", bucket)
    left = "doc_id long, sha256 string, n_removed long, kept string, kept_sha256 string"
    kept = dealt.groupBy("bucket").cogroup(pieces.groupBy("bucket")).applyInArrow(_located(window), left)
    kept = settle(kept.filter("n_removed > 0").dropDuplicates(["doc_id", "sha256"]), "kept")
    return base, kept


def repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every row of ``docs`` (doc_id, text).

    Words are what stands between blanks, tabs and line ends. A word goes if a window of ``window``
    words that covers it also starts in a document with a smaller id; the windows are those
    of the input. Null and empty texts have no words; their digest is that of the empty text. Rows that repeat a doc_id
    count as one document, so they do not shorten each other; a null doc_id neither
    shortens nor is shortened. Other columns are ignored.
    """
    base, kept = _found(_plain(docs), window)
    return base.join(kept.drop("kept"), ["doc_id", "sha256"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the text of documents that repeat others cut down to the words that stay.

    Those words are joined by one blank; other texts stay as they are. A document of which
    nothing stays goes. All columns are kept, ``n_chars`` is counted anew where it is there.
    """
    plain = _plain(docs)
    _, kept = _found(plain, window)
    # Own columns get names that docs has not.
    id_, sha, rest = (fresh(name, docs.columns) for name in ("_id", "_sha", "_kept"))
    ids = kept.select(F.col("doc_id").alias(id_)).distinct()
    marked = docs.withColumn(id_, F.col("doc_id").cast("long"))
    same = of_ids(marked, ids, "left_anti", id_).select(*docs.columns)
    changed = of_ids(marked, ids, "left_semi", id_).withColumn(sha, _digest())
    changed = changed.join(kept.select(F.col("doc_id").alias(id_), F.col("sha256").alias(sha), F.col("kept").alias(rest)), [id_, sha], "left")
    changed = changed.filter(F.col(rest).isNull() | (F.col(rest) != "")).withColumn("text", F.coalesce(rest, "text"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(changed.select(*docs.columns))
