"""Records of csv files of any size, from lines of splits.

Whether a split starts inside quotes depends on all that stands before it. So a first pass summarises each
split for both cases: which state it ends in if it starts outside quotes, and which if inside. These summaries compose; folded in
order they give the state at the start of every split. A second pass cuts each split into records from its known state. What a split's
borders cut apart, the head of a split that starts inside quotes and its open last record, goes out as pieces, which are put together per
record. Records are numbered within their split and shifted by the counts of the splits before.

Both passes go through the lines of a task in order and hold one open record; nothing but summaries, pieces and records of
interest is shuffled. A record has to fit into a value.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.emails import RELAXED, has_email
from exposcan.functions.text import valid_utf8
from exposcan.operators.sniff import sniff_csv_text
from exposcan.session import free_shuffles, materialise

# The functions of this module go to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HEAD = fv.HEAD_LINES
#: Files whose quotes cross splits go to every task up to this number, a path and some numbers each.
FEW_FILES = 10_000

# The cells of functions.tabular, on the bytes of one line.
_QUOTED = rb'"[^"]*+(?:""[^"]*+)*+'
_OPEN_AT_END = re.compile(rb'(?:(?:%b"[^,]*+|[^",][^,]*+|),)*+%b' % (_QUOTED, _QUOTED))
_CLOSES = re.compile(rb'[^"]*+(?:""[^"]*+)*+"[^,]*+(,?)')


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether quotes are open after ``line``, which starts inside quotes or with a cell."""
    if b'"' not in line:
        return inside
    if inside:
        closed = _CLOSES.match(line)
        if not closed:
            return True
        if not closed.group(1):
            return False
        line = line[closed.end():]
    return _OPEN_AT_END.fullmatch(line) is not None


def text_lines(line: bytes) -> list[bytes]:
    """The lines a text-mode reader makes of what stands between line feeds."""
    return (line[:-1] if line.endswith(b"\r") else line).split(b"\r") if b"\r" in line else [line]


def _is_header(record: bytes) -> bool:
    """Whether the first record is the header and reads alike as text: not if it is blank, or starts with a byte order mark or what does not decode."""
    try:
        text = record.decode()
    except UnicodeDecodeError:
        return False
    return not text.startswith("\ufeff") and bool(text.split("\n")[0].strip(" \t"))


def _by_split(batches, columns):
    """(path, block, rows) in order; a split may go on in the next batch, then it comes again."""
    for batch in batches:
        paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
        values = [batch.column(c).to_pylist() for c in columns]
        start = 0
        for at in range(1, len(paths) + 1):
            if at == len(paths) or blocks[at] != blocks[start] or paths[at] != paths[start]:
                yield paths[start], blocks[start], [v[start:at] for v in values]
                start = at


def _summaries(batches):
    """One row per split with quotes: the state at its end for either state at its start."""
    now, outside, inside, out = None, False, True, []
    for path, block, (lines,) in _by_split(batches, ["line"]):
        if now != (path, block):
            if now:
                out.append((*now, outside, inside))
            now, outside, inside = (path, block), False, True
        for raw in lines:
            for line in text_lines(raw):
                outside, inside = ends_inside(line, outside), ends_inside(line, inside) if outside != inside else ends_inside(line, outside)
        if len(out) >= 1024:
            yield _states(out)
            out = []
    if now:
        out.append((*now, outside, inside))
    yield _states(out)


def _states(rows):
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "block", "from_outside", "from_inside"])


def _quotes_crossing(pieces: DataFrame) -> DataFrame:
    """``path, states``: of files with quotes open between splits, the state after each split that holds a quote."""
    quoted = pieces.where(F.col("line").contains('"')).select("path", "block", F.col("line").cast("binary").alias("line"))
    splits = quoted.mapInArrow(_summaries, "path string, block long, from_outside boolean, from_inside boolean")
    ordered = F.array_sort(F.collect_list(F.struct("block", "from_outside", "from_inside")))
    first = F.array().cast("array<struct<block:bigint,inside:boolean>>")

    def step(states: Column, split: Column) -> Column:
        before = F.coalesce(F.get(states, F.size(states) - 1)["inside"], F.lit(False))
        now = F.when(before, split["from_inside"]).otherwise(split["from_outside"])
        return F.concat(states, F.array(F.struct(split["block"].alias("block"), now.alias("inside"))))

    files = splits.groupBy("path").agg(F.aggregate(ordered, first, step).alias("states"))
    return files.where(F.exists("states", lambda s: s["inside"]))


def _starts_inside(states: Column, block: Column) -> Column:
    before = F.filter(states, lambda s: s["block"] < block)
    return F.coalesce(F.get(before, F.size(before) - 1)["inside"], F.lit(False))


def _inside_starts(pieces: DataFrame, crossing: DataFrame) -> DataFrame:
    """``path, block`` of the splits that start inside quotes."""
    after = crossing.select("path", F.explode("states").alias("state")).select("path", "state.block", "state.inside")
    before = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = pieces.select("path", "block").distinct().join(after, ["path", "block"], "left").withColumn("starts", F.last("inside", True).over(before))
    return starts.where("starts").select("path", "block")


_WHOLE, _END, _BEGIN, _THROUGH, _SPLIT = range(5)
_CUT = "path string, block long, kind int, at long, text binary, head array<binary>, headed boolean"


def _cut(batches):
    """Records and pieces of splits: kind, number (from 0) of the record in its split, text; and a row per split with its count and head.

    ``headed`` tells of the first split of a file whether the header ends in its head. A row without line says where its split starts.
    """
    now, out = None, []
    open_: list[bytes] = []
    state = {"inside": False, "continued": False, "n": 0, "first": True, "head": [], "headed": False}

    def finish():
        path, block = now
        if state["continued"]:
            out.append((path, block, _THROUGH, state["n"], b"\n".join(open_), None, None))
        elif state["inside"]:
            out.append((path, block, _BEGIN, state["n"], b"\n".join(open_), None, None))
        out.append((path, block, _SPLIT, state["n"], None, state["head"], state["headed"]))
        open_.clear()

    def batch():
        columns = list(zip(*out)) or [()] * 7
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.bool_())
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "block", "kind", "at", "text", "head", "headed"])
        out.clear()
        return made

    for path, block, (lines, inside) in _by_split(batches, ["line", "inside"]):
        if now != (path, block):
            if now:
                finish()
            now = (path, block)
            state = {"inside": inside[0], "continued": inside[0], "n": 0, "first": block == 0, "head": [], "headed": False}
        for raw in lines:
            for line in text_lines(raw) if raw is not None else ():
                if len(state["head"]) < _HEAD:
                    state["head"].append(line)
                was = state["inside"]
                state["inside"] = ends_inside(line, was)
                if was or state["inside"]:
                    open_.append(line)
                if state["inside"]:
                    continue
                if was and state["continued"]:
                    out.append((path, block, _END, state["n"], b"\n".join(open_), None, None))
                    state["continued"] = False
                    state["n"] += 1
                else:
                    record = b"\n".join(open_) if was else line
                    if state["first"] and len(open_) <= _HEAD:
                        state["headed"] = _is_header(record)
                    if record or state["first"]:
                        if b"@" in record or state["first"]:
                            out.append((path, block, _WHOLE, state["n"], record, None, None))
                        state["n"] += 1
                state["first"] = False
                open_.clear()
        if len(out) >= 1024:
            yield batch()
    if now:
        finish()
    yield batch()


def cut_csv(pieces: DataFrame) -> DataFrame:
    """Splits of csv files cut into records and pieces, from ``path, block, place, line``.

    ``pieces`` is read twice, as the states between splits are kept. Lines stay where they are, unless more than ``FEW_FILES`` files
    have quotes that cross splits: then they are dealt out once, and what it takes can go when the result is written.
    """
    crossing = materialise(_quotes_crossing(pieces))
    lines = pieces.select("path", "block", "place", F.col("line").cast("binary").alias("line"))
    if crossing.limit(FEW_FILES + 1).count() <= FEW_FILES:
        lines = lines.join(F.broadcast(crossing), "path", "left")
        lines = lines.withColumn("inside", F.when(F.col("states").isNull(), F.lit(False)).otherwise(_starts_inside(F.col("states"), F.col("block"))))
    else:
        # A row before the lines of a split says that it starts inside, so lines are dealt out once and joined with nothing.
        starts = materialise(_inside_starts(pieces, crossing))
        free_shuffles(pieces.sparkSession)
        none = F.lit(None).cast("binary").alias("line")
        marks = starts.select("path", "block", F.lit(-1).cast("long").alias("place"), none, F.lit(True).alias("inside"))
        lines = lines.withColumn("inside", F.lit(False)).unionByName(marks)
        lines = lines.repartition("path", "block").sortWithinPartitions("path", "block", "place")
    cut = lines.select("path", "block", "line", "inside").mapInArrow(_cut, _CUT)
    head = F.transform("head", lambda x: valid_utf8(x.cast("string")))
    found = F.transform(head, lambda x: F.coalesce(has_email(x, RELAXED), F.lit(False)))
    opening = F.when(F.col("headed"), sniff_csv_text(F.array_join(head, "\n")))
    return cut.select("path", "block", "kind", "at", "text", found.alias("found"), opening.alias("opening"))


def csv_heads(pieces: DataFrame) -> DataFrame:
    """``path, head``: the first ten lines of each file, joined; a head may come from several splits."""
    in_file = F.row_number().over(W.partitionBy("path").orderBy("block", "place"))
    first = pieces.withColumn("rank", in_file).where(F.col("rank") <= _HEAD)
    lines = F.array_sort(F.collect_list(F.struct("rank", F.split(F.regexp_replace(valid_utf8(F.col("line")), r"\r\z", ""), "\r", -1).alias("lines"))))
    files = first.groupBy("path").agg(F.flatten(F.transform(lines, lambda x: x["lines"])).alias("lines"))
    return files.select("path", F.array_join(F.slice("lines", 1, _HEAD), "\n").alias("head"))


def csv_contacts(cut: DataFrame, pieces: DataFrame) -> DataFrame:
    """``path, contact``: ``sniff_csv_text`` of the head of each file, from its splits as cut and as read.

    The header mostly ends in the first split. Then the other splits tell only which of their first lines hold an address, and no text is
    shuffled. If there are other files, ``pieces`` is read again for their heads.
    """
    splits = cut.where(F.col("kind") == _SPLIT)
    files = splits.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("block", "found"))).alias("splits"), F.bool_or("opening").alias("opening"))
    first = F.slice(F.flatten(F.transform("splits", lambda s: s["found"])), 1, _HEAD)
    files = materialise(files.select("path", "opening", (F.col("opening") | F.exists(first, lambda x: x)).alias("contact")))
    known, others = files.where("opening IS NOT NULL").select("path", "contact"), files.where("opening IS NULL").select("path")
    if others.isEmpty():
        return known
    heads = csv_heads(pieces.join(others, "path", "left_semi"))
    return known.unionByName(heads.select("path", sniff_csv_text(F.col("head")).alias("contact")))


def csv_piece_records(cut: DataFrame) -> DataFrame:
    """``path, row_no, record``: the header of each file, as row 0, and all records that hold an ``@``.

    Records are shuffled once, to their split's row; the pieces of others by file, with the rows of its splits among them.
    """
    splits = cut.where(F.col("kind") == _SPLIT).select("path", "block", "at")
    before = F.sum("at").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    skipped = splits.select("path", "block", F.coalesce(before, F.lit(0)).alias("skipped"))
    whole = cut.where(F.col("kind") == _WHOLE).select("path", "block", "at", F.col("text").cast("string").alias("record"))
    whole = whole.join(skipped, ["path", "block"]).select("path", (F.col("at") + F.col("skipped")).alias("row_no"), "record")

    pieces = cut.where(F.col("kind").isin(_END, _BEGIN, _THROUGH, _SPLIT)).select("path", "block", "kind", "at", "text")
    in_file = W.partitionBy("path").orderBy("block", "kind")  # the row of a split comes last in it
    begins, split = F.col("kind") == _BEGIN, F.col("kind") == _SPLIT
    pieces = pieces.withColumns({
        "record": F.sum(F.when(begins, 1).otherwise(0)).over(in_file.rowsBetween(W.unboundedPreceding, 0)),
        "skipped": F.when(split, F.coalesce(F.sum(F.when(split, F.col("at"))).over(in_file.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))),
    })
    pieces = pieces.withColumn("skipped", F.collect_list("skipped").over(W.partitionBy("path", "block"))).where(~split)
    # Where it began, the record is the next one after those that ended in that split.
    joined = pieces.groupBy("path", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "kind", "text"))).alias("parts"),
        F.min(F.struct("block", "at", "skipped")).alias("begin"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), "\n").alias("record")
    joined = joined.select("path", "begin.at", F.explode("begin.skipped").alias("skipped"), text).select("path", (F.col("at") + F.col("skipped")).alias("row_no"), "record")
    records = whole.unionByName(joined).withColumn("record", valid_utf8(F.col("record")))
    return records.where((F.col("row_no") == 0) | F.col("record").contains("@"))
