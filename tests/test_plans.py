"""Shapes of physical plans: what is read, what moves, what is combined before it moves."""

import re

import pytest
from pyspark.sql import functions as F

from checks import tables
from exposcan import session
from exposcan.operators import dedup, joins, ordered, routing, sinks
from exposcan.plans import identity, index, lanes
from exposcan.sources import files as fs
from exposcan.sources import csv_pieces, findings_json
from exposcan.sources.records import sheet_records

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan(df)))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def text_lane(documents, doc="doc_id"):
    return lanes.text_lane(fs.cut_pieces(documents, doc, "text"))


def test_text_lane_moves_splits_and_findings(documents):
    """What leaves the scan is combined there by a hash aggregate; lines and texts stay."""
    shape = plan(text_lane(documents))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in shape
    assert "StringContains(text,@)" in shape
    scans = shape.split("partial_bit_xor")
    assert len(scans) > 1 and all("Exchange" not in part.split("FileScan")[0] for part in scans[1:])
    first = re.search(r"HashAggregate\(keys=\[path[^\n]*partial_bit_xor[^\n]*", shape).group()
    assert "line#" not in first and "SortAggregate" not in first


def test_csv_lane_moves_nothing(documents):
    assert exchanges(lanes.csv_lane(documents, "doc_id", "text")) == 0


def test_xml_lane_moves_findings_once(documents):
    assert exchanges(lanes.xml_lane(documents, "doc_id", "text")) == 1


def test_copies_are_combined_before_they_move(documents):
    shape = plan(dedup.dedup_files(documents, "doc_id", "text"))
    assert "Window" not in shape and shape.count("HashAggregate") == 2
    keyed = documents.select(F.sha1("text").alias("id"), "doc_id", "lang")
    shape = plan(dedup.dedup_by_id(keyed, ["doc_id"]))
    assert "partial_max_by" in shape and "Window" not in shape


def test_listing_reads_no_content(spark):
    assert "ReadSchema: struct<path:string,length:bigint>" in plan(fs.list_files(spark, SF))


def test_head_is_limited_before_it_moves(documents):
    shape = plan(ordered.head_n(documents.select("source", "doc_id"), "source", "doc_id", 10))
    assert re.search(r"WindowGroupLimit .*Final", shape) and re.search(r"WindowGroupLimit .*Partial", shape)


def test_only_the_extension_table_is_forced_to_broadcast(spark, documents):
    files = documents.select("source", F.col("lang").alias("ext"), F.col("doc_id").cast("string").alias("path"), F.lit("n").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(routing.route_by_extension(files))
        verdict = documents.select("doc_id").where("doc_id > 3")
        assert "Broadcast" not in plan(joins.keep_qualified(documents.select("doc_id", "lang"), verdict, "doc_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_split_when_the_join_runs(spark):
    """A third of the rows have one key: its partition is split, and no side is copied beforehand."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("doc"), F.uuid().alias("text"))
        files = spark.range(0, 300_000, 1, 8).select(F.col("id").alias("doc")).where("doc % 2 = 0")
        kept = joins.keep_qualified(many, files, "doc")
        assert "Expand" not in plan(kept) and "Generate" not in plan(kept)
        assert len(kept.collect()) == 100_000 + 100_000
        assert "skew=true" in plan(kept)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_hot_groups_give_the_same_rows(spark):
    copies = spark.range(3000).select(F.col("id").alias("doc"), F.when(F.col("id") % 3 == 0, "u@example.com once").otherwise(
        F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@example.com"))).alias("text"))
    found = text_lane(copies, "doc")
    assert found.count() == 2001
    assert found.where("email = 'u@example.com'").first().file == 0


def test_replies_of_one_split_go_to_all_cores(spark):
    assert tables.table(spark, SF, "customer").rdd.getNumPartitions() == 1
    assert tables.replies(spark, SF).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_filter_on_identity_fields_parses_nothing_again(spark):
    files = spark.createDataFrame([("a", '{"Information":{"Name":"N"}}'), ("b", '{"Information":{}}'), ("c", '{"Information":1}')], "file string, json string")
    read = findings_json.read_identity_json(files, "file", "json")
    kept = identity.require_identity(read)
    assert plan(kept).count("from_json") == plan(read).count("from_json")
    assert [r.file for r in kept.collect()] == ["a"] and read.count() == 2


def test_csv_lines_are_summarised_once(spark, tmp_path):
    """The summaries are done when the lines are cut: one pass is left, whatever joins the states."""
    (tmp_path / "a.csv").write_text('name,note\n1,"u@example.com\nmore"\n' * 20)
    cut = csv_pieces.cut_csv(fs.read_pieces(spark, str(tmp_path), "*.csv"))
    assert plan(cut).count("MapInArrow") == 1 and cut.count() > 20


def test_numbers_that_cannot_be_null_are_not_searched_for_gaps(spark):
    texts = spark.createDataFrame([(1, "a\n\nb"), (2, "c")], "doc int, text string")
    lines = texts.select("doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    gaps = lines.withColumn("line_no", F.when(F.col("line") != "", F.col("line_no")))

    def read(table):
        records = sheet_records(table, F.col("doc"), F.col("line_no"), ["line_no", "line"])
        numbers = records.select("file", F.col("fields")[0]["value"].alias("value")).collect()
        return exchanges(records), sorted((r.file, r.value) for r in numbers)

    assert read(lines) == (0, [(1, "0"), (1, "1"), (1, "2"), (2, "0")])
    moved, numbers = read(gaps)
    assert moved and numbers == [(1, ""), (1, "0.0"), (1, "2.0"), (2, "0")]


def test_lines_of_many_crossing_files_are_dealt_out_once(spark, tmp_path, monkeypatch):
    """No join of lines and no text of heads; in passes by file the findings are the same."""
    rows = [(f"f{n}", 'name,note\n' + f'1,"u{n}@example.com\nmore"\n' * n) for n in range(6)]
    rows += [("blank", '\n\nid,Email\n1,b@example.com\n'), ("mark", '﻿"id","Email\n"\n1,"m\nm@example.com"\n'), ("late", "a,b\n" + "1,2\n" * 9 + "1,l@example.com\n")]
    files = spark.createDataFrame(rows, "doc string, text string")
    pieces = fs.cut_pieces(files, "doc", "text", F.lit(2))

    def found():
        return sorted(map(tuple, lanes.csv_piece_lane(pieces).select("file", "row_no", "email", "email_context").collect()))

    want = sorted(map(tuple, lanes.csv_lane(files, "doc", "text").select("file", "row_no", "email", "email_context").collect()))
    assert len(want) == 16 and found() == want
    monkeypatch.setattr(csv_pieces, "FEW_FILES", 0)
    cut = csv_pieces.cut_csv(pieces)
    assert exchanges(cut) == 1 and "Join" not in plan(cut) and "head" not in cut.columns
    monkeypatch.setattr(session, "PASS_BYTES", 1)
    assert found() == want


def test_large_scans_are_not_dealt_out(spark, monkeypatch):
    scan = spark.read.parquet(f"{SF}/documents.parquet")
    assert exchanges(session.spread(scan)) == 1
    monkeypatch.setattr(session, "SPREAD_BYTES", 1)
    assert exchanges(session.spread(scan)) == 0


def test_lanes_are_written_one_by_one_and_extracts_go(spark, tmp_path, monkeypatch):
    """The index is the same in passes by id; what was written in between is deleted."""
    monkeypatch.setattr(session, "_shared_folder", lambda spark: str(tmp_path))
    sources = spark.createDataFrame([(1, "a", "t", "t"), (1, "b", "u", "u")], "id int, post_title string, indexed string, discovered string")
    names = ["id", "email", "email_context", "domain", "from", "id_source", "lane", "file", "seq"]
    kinds = "id string, email string, email_context string, domain string, `from` string, id_source int, lane int, file string, seq bigint"

    def lanes_of():
        for lane in (1, 2, 3):
            rows = [(f"i{n}" if n else "", f"e{n}", "c", "d", f"f{lane}", 1 if n < 40 else 2, lane, f"x{n}", 0) for n in range(50 + lane)]
            assert len(list(tmp_path.glob("exposcan-extracts/*"))) == (lane > 1)
            yield session.materialise(spark.createDataFrame(rows, kinds))

    found = []
    for most in (session.PASS_BYTES, 1):
        monkeypatch.setattr(session, "PASS_BYTES", most)
        index.index_run(lanes_of(), sources, root := str(tmp_path / f"index{most}"), sinks.RAW)
        found.append(sorted(map(tuple, sinks.read_findings(spark, root).select(*names[:6]).collect())))
        assert not list(tmp_path.glob("exposcan-extracts/*"))
    assert found[0] == found[1] and len(found[0]) == 39 + 3 and {r[4] for r in found[0] if r[0]} == {"f3"}
