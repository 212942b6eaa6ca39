"""Hand-made cases for operators, lanes and sinks."""

import csv
import hashlib
import hmac
import io
import json
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.operators import dedup, joins, ordered, report, routing, sinks, sniff
from exposcan.plans import identity, index, lanes, organise
from exposcan.sources import files as fs
from exposcan.sources import findings_json as fj
from exposcan.sources import csv_pieces, records


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def sha1(text):
    return hashlib.sha1(text.encode()).hexdigest()


def test_routing_edges(spark):
    files = spark.createDataFrame([
        ("a/x.PDF", "x.PDF", "PDF", 512, False), ("a/none", "none", "", 600, False), ("a/y.exe", "y.exe", "exe", 600, False),
        ("a/small.txt", "small.txt", "txt", 511, False), ("a/l.txt", "l.txt", "txt", 600, True),
        ("a/n.txt", "n.txt", "txt", 600, False), ("b/n.txt", "n.txt", "txt", 700, False),
    ], "path string, name string, ext string, size bigint, is_link boolean")
    kept = rows(organise.organise(files).select("bucket", "path", "size"), "path")
    assert kept == [("Dir_texto", "a/none", 600), ("Dir_PDF", "a/x.PDF", 512), ("Dir_texto", "b/n.txt", 700)]
    verdicts = dict(rows(organise.file_verdicts(files).select("path", "verdict")))
    assert verdicts["a/y.exe"] == "unknown_extension" and verdicts["a/small.txt"] == "small" and verdicts["a/l.txt"] == "link"


def test_titles(spark):
    names = spark.createDataFrame([("Hiring_CV.docx",), ("cv.docx",)], "name string")
    assert rows(routing.route_by_title(names), "name") == [("cv.docx", False), ("hiring_cv.docx", True)]


def test_page_gate_and_last_context(spark):
    long = "x" * 60
    pages = [("late", 31, "a@b.cc " + long), ("both", 30, "a@b.cc " + long), ("both", 31, "p31 a@b.cc z@b.cc " + long),
             ("twice", 1, "one a@b.cc " + long), ("twice", 2, "two a@b.cc " + long), ("short", 1, "a@b.cc"),
             ("review", 1, "a@b.cc " + long)]
    table = spark.createDataFrame(
        [(d, "hiring cv.pdf" if d == "review" else f"{d}.pdf", n, t) for d, n, t in pages], "doc string, name string, page_no int, text string")
    assert rows(sniff.page_gate(table.drop("name")), "doc") == [("both",), ("review",), ("short",), ("twice",)]
    found = rows(lanes.pdf_lane(table).select("file", "email", "email_context", "origin"), "file", "email")
    assert found == [
        ("both", "a@b.cc", "p31 a@b.cc z@b.cc " + long, "both"), ("both", "z@b.cc", "p31 a@b.cc z@b.cc " + long, "both"),
        ("twice", "a@b.cc", "two a@b.cc " + long, "twice"),
    ]


def test_digital_verdicts(spark):
    pages = spark.createDataFrame([
        ("fifty", 1, "  " + "x" * 50 + "\n"), ("fiftyone", 1, "x" * 51), ("split", 1, " " * 60), ("split", 2, "y" * 51),
        ("gap", 1, "a"), ("gap", 2, " " * 49), ("gap", 3, "b\n"), ("nogap", 1, "a"), ("nogap", 2, " " * 48), ("nogap", 3, "b"),
        ("edges", 1, " " * 90), ("edges", 2, "a"), ("edges", 3, " " * 90),
    ], "doc string, page_no int, text string")
    assert dict(rows(sniff.paged_digital(pages))) == {
        "fifty": False, "fiftyone": True, "split": True, "gap": True, "nogap": False, "edges": False}
    blocks = pages.withColumnRenamed("page_no", "seq")
    office = dict(rows(sniff.office_digital(blocks)))
    # The reader stops after sixty blanks, so the second block is never read.
    assert office["split"] is False and office["fiftyone"] is True and office["fifty"] is False
    texts = blocks.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("b"))
    same = dict(rows(texts.select("doc", sniff.office_digital_blocks(F.transform("b", lambda b: b["text"])))))
    assert same == office


def test_running_chars_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK", 3)
    blocks = [("d", n, "x" * (n % 4)) for n in range(40)] + [("e", 5, None), ("e", 6, "y" * 60), ("e", 7, "z")]
    table = spark.createDataFrame(blocks, "doc string, seq int, text string")
    got = rows(ordered.running_chars(table).select("doc", "seq", "chars_before"), "doc", "seq")
    expected, total = [], 0
    for _, n, text in blocks[:40]:
        if total <= 50:
            expected.append(("d", n, total))
        total += len(text)
    assert got == expected + [("e", 5, 0), ("e", 6, 0)]


@pytest.mark.parametrize("header, kept", [("Email,x", True), ("e-mail,x", False), ('id,"NAME"', True), ("\n  \nname", True), ("id", False)])
def test_csv_header_verdict(spark, header, kept):
    df = spark.createDataFrame([(header + "\n1,2\n",)], "t string")
    assert df.select(sniff.sniff_csv_text(F.col("t"))).first()[0] is kept


def test_csv_address_after_the_tenth_line(spark):
    text = "id,x\n" + "1,2\n" * 8
    df = spark.createDataFrame([(text + "1,a@b.cc\n",), (text + "1,2\n1,a@b.cc\n",), ("",)], "t string")
    assert [r[0] for r in df.select(sniff.sniff_csv_text(F.col("t"))).collect()] == [True, False, False]


def text_lane(files, seen=None):
    return lanes.text_lane(fs.cut_pieces(files, "doc", "text"), seen)


def test_text_lane_cases(spark):
    gap = "." * 400
    texts = [(3, "me@example.com first\nme@example.com second"), (1, f"x@example.com {gap} x@example.com"),
             (2, f"x@example.com {gap} x@example.com"), (4, ""), (5, None), (6, "o'neil@example.com")]
    files = spark.createDataFrame(texts, "doc int, text string")
    got = rows(text_lane(files).select("file", "email", "email_context", "id"), "file")
    one = f"x@example.com {gap}"[:13 + 150].strip()
    two = "me@example.com first"
    assert got == [(1, "x@example.com", one, sha1(f"x@example.com_{one}")), (3, "me@example.com", two, sha1(f"me@example.com_{two}"))]
    seen = lanes.file_digests(lanes.split_findings(fs.cut_pieces(files.where("doc = 3"), "doc", "text")))
    assert [r[0] for r in rows(text_lane(files, seen).select("file"))] == [1]


def test_results_do_not_depend_on_partitions(spark):
    texts = [(n, f"user{n % 7}@example.com line {n % 11}\nand x{n % 5}@example.org") for n in range(200)]
    files = spark.createDataFrame(texts, "doc int, text string")
    results = [sorted(map(tuple, text_lane(files.repartition(p)).collect())) for p in (1, 8)]
    assert results[0] == results[1]


def test_office_lane(spark):
    long = "z" * 60
    blocks = spark.createDataFrame([
        ("a", "a", "docx", 1, long), ("a", "a", "docx", 2, "me@x.cc one"), ("a", "a", "docx", 3, "me@x.cc two"),
        ("b", "b", "PPTX", 1, long + " me@x.cc"), ("c", "c", "doc", 1, long + " me@x.cc"), ("d", "d", "docx", 1, "me@x.cc"),
    ], "doc string, name string, ext string, seq int, text string")
    got = rows(lanes.office_lane(blocks).select("file", "email_context", "origin"), "file")
    assert got == [("a", f"{long} me@x.cc one me@x.cc two", fv.DOCX_ORIGIN), ("b", long + " me@x.cc", fv.PPTX_ORIGIN)]


def test_sheet_lane(spark):
    cell = lambda name, value, raw=False: (name, value, raw)
    table = spark.createDataFrame(
        [("early", 1, [cell("a", "Ann <a@example.com>"), cell("n", "5", True)]), ("early", 11, [cell("a", "b@example.com"), cell("n", "", False)])]
        + [("late", 11, [cell("a", "c@example.com")]), ("headed", 20, [cell("NAME", "x"), cell("b", "d@example.com")])],
        "file string, row_no bigint, fields array<struct<name:string,value:string,raw:boolean>>",
    )
    got = rows(lanes.sheet_lane(table).select("file", "row_no", "email", "email_context"), "file", "row_no")
    assert got == [("early", 1, "Ann <a@example.com>", '{"n": 5}'), ("early", 11, "b@example.com", '{"n": ""}'), ("headed", 20, "d@example.com", '{"NAME": "x"}')]


def test_sheet_records_types(spark):
    table = spark.createDataFrame([(1, 1.5, None, True, "t"), (2, float("nan"), 3, None, None), (3, 12345678.25, 4, False, "u")],
                                  "k int, f double, n int, b boolean, s string")
    got = rows(records.sheet_records(table, F.lit("f"), F.col("k"), ["f", "n", "b", "s"]).select("row_no", "fields"), "row_no")
    values = [[(f.value, f.raw) for f in r[1]] for r in got]
    assert values[0] == [("1.5", True), ("", False), ("true", True), ("t", False)]
    # The gap in the first row makes floats of the column's whole numbers, as in the published reader.
    assert values[1] == [("", False), ("3.0", True), ("", False), ("", False)]
    assert values[2][0] == ("12345678.25", True)


def test_a_gap_counts_in_its_own_file_only(spark):
    table = spark.createDataFrame([("a", 1, 5, 2), ("a", 2, None, 3), ("b", 1, 7, 4), ("b", 2, 1 << 60, 5)], "file string, k int, n long, cells int")
    got = rows(records.sheet_records(table, F.col("file"), F.col("k"), ["n", "cells"]).select("file", "row_no", "fields"), "file", "row_no")
    assert [[f.value for f in r[2]] for r in got] == [["5.0", "2"], ["", "3"], ["7", "4"], [str(1 << 60), "5"]]


def test_floats_as_python_writes_them(spark):
    numbers = [1e16, 4.5e17, 1e-5, 1.25e-7, 1e15, 0.0001, 123456789012345.6, 1e100, -3e22, 0.0, 12345678.0, -1.5e-300, 2.5]
    table = spark.createDataFrame([(k, x) for k, x in enumerate(numbers)], "k int, f double")
    got = rows(records.sheet_records(table, F.lit("f"), F.col("k"), ["f"]).select("row_no", "fields"), "row_no")
    assert [r[1][0].value for r in got] == [str(x) for x in numbers]


def test_xml_lane(spark):
    long = "<p>{}</p>"
    docs = spark.createDataFrame([
        ("a", "<d><p>write to a&#64;b.cc</p><p>email</p></d>"), ("b", "<d>" + "\n" * 12 + "a@b.cc</d>"), ("c", "<d>email a@b.cc"),
        ("d", "<d><p>a@b.cc one</p>" + long.format("-" * 500) + "<p>two a@b.cc</p></d>"),
    ], "doc string, xml string")
    got = rows(lanes.xml_lane(docs, "doc", "xml").select("file", "email", "email_context"), "file")
    assert got == [("a", "a@b.cc", "write to a@b.cc email"), ("d", "a@b.cc", ("-" * 195 + " two a@b.cc"))]


def test_findings_json_edges(spark):
    array = [{"email": "A@x.cc", "email_context": {"id": 1, "é": None}}, {"email": "no@context.cc"}, {"email": "n@x.cc", "email_context": None},
             {"email": "s@x.cc", "email_context": "{text, with: marks}"}]
    files = spark.createDataFrame([("good", json.dumps(array)), ("bad", "[{"), ("trail", json.dumps(array[:1]) + "x")], "file string, json string")
    got = rows(fj.read_array_findings(files, "file", "json").select("email", "email_context", "id"), "seq")
    context = json.dumps(array[0]["email_context"])
    assert got == [("A@x.cc", context, sha1("a@x.cc" + context)), ("n@x.cc", "None", sha1("n@x.ccNone")),
                   ("s@x.cc", "{text, with: marks}", sha1("s@x.cc{text, with: marks}"))]
    good, bad = report.quarantine(files, "json")
    assert [r.file for r in good.collect()] == ["good"] and sorted(r.file for r in bad.collect()) == ["bad", "trail"]
    keyed = spark.createDataFrame([("f", '{"a@b.cc": {"email_context": "c", "ID": "1"}}')], "file string, json string")
    assert rows(fj.read_keyed_findings(keyed, "file", "json")) == [("f", "a@b.cc", "c", "1", "")]


def test_repeated_keys_and_odd_members(spark):
    text = '{"a@b.cc": {"email_context": "x"}, "b@b.cc": "text", "c@b.cc": {"email_context": "1", "email_context": "2", "ID": "7"}, "a@b.cc": {"ID": "3"}, "d@b.cc": null}'
    files = spark.createDataFrame([("f", text)], "file string, json string")
    assert rows(fj.read_keyed_findings(files, "file", "json"), "email") == [("f", "a@b.cc", "", "3", ""), ("f", "c@b.cc", "2", "7", "")]
    assert rows(fj.odd_members(files, "file", "json"), "email") == [("f", "b@b.cc"), ("f", "d@b.cc")]


def test_contexts_that_are_no_objects(spark):
    values = [True, False, [1, True, None, "it's", 'a"b', "x\\y\nz", {"k": [1.5, 1e22]}], 5, 1e22, 12345678.0, [], "true"]
    text = json.dumps([{"email": f"{k}@x.cc", "email_context": v} for k, v in enumerate(values)])
    files = spark.createDataFrame([("f", text)], "file string, json string")
    got = [r.email_context for r in fj.read_array_findings(files, "file", "json").orderBy("seq").collect()]
    assert got == [str(v) for v in values]


def test_falsy_identity_values(spark):
    infos = [{"Name": 0, "ID Number": ""}, {"Name": "0", "ID Number": False}, {"Name": [], "ID Number": {}}, {"Name": "n", "Expiration Date": False, "Date of Birth": "x"}]
    table = spark.createDataFrame([(str(k), json.dumps({"Information": i})) for k, i in enumerate(infos)] + [("9", '{"Information": {"Name": "", "Name": "last"}}')], "image string, reply string")
    got = rows(identity.judge_replies(table, "image", "reply").select("file", "status", "Name", "`Expiration Date`", "`Date of Birth`"), "file")
    assert [r[1] for r in got] == ["skipped", "indexed", "skipped", "indexed", "indexed"]
    assert got[3][3:] == ("", "x") and got[4][2] == "last"


def test_dedup_by_id(spark):
    table = spark.createDataFrame([("1", "txt", "a"), ("1", "xml", "b"), ("1", "csv", "c"), ("", "txt", "d"), ("", "txt", "e")], "id string, kind string, file string")
    ranked = table.withColumn("lane", dedup.lane_rank(F.col("kind")))
    assert rows(dedup.dedup_by_id(ranked, ["lane", "file"]).select("id", "file"), "id", "file") == [("", "d"), ("", "e"), ("1", "b")]


def test_report_lists_every_file(spark):
    outcomes = spark.range(1000).select(F.col("id").cast("string").alias("file"), F.when(F.col("id") % 10 == 0, "skipped").otherwise("error").alias("status"))
    parts = report.run_report(outcomes, per_part=50).collect()
    assert sum(p.n for p in parts if p.status == "error") == 900
    assert sorted(f for p in parts for f in p.files) == sorted(str(n) for n in range(1000))
    assert max(p.n for p in parts) < 150


def test_replies(spark):
    good = '```{"Information": {"Name": "N", "ID Number": "1", "Expiration Date": ""}}```'
    table = spark.createDataFrame([("a.png", good), ("b.png", "prose"), ("c.png", '{"Information": {"Country": "X"}}'), ("d.png", '{"Other": 1}'),
                                   ("e.png", '{"Information": null}')], "image string, reply string")
    got = identity.identity_records(table, "image", "reply", F.lit(7)).collect()
    assert [(r["Name"], r["ID Number"], r["Expiration Date"], r["Country"], r["FROM"], r["id_source"]) for r in got] == [("N", "1", None, "", "a.png", 7)]
    outcome = {r.status: (r.n, r.files) for r in identity.identity_report(table, "image", "reply").collect()}
    assert outcome == {"indexed": (1, ["a.png"]), "error": (2, ["b.png", "e.png"]), "skipped": (1, ["c.png"])}


FINDINGS = "id string, email string, email_context string, domain string, `from` string, id_source int, seq int"


def test_upsert_versions(spark, tmp_path):
    root = str(tmp_path / "index")
    first = spark.createDataFrame([("1", "a@x.cc", "old", "x.cc", "f", 1, 0), ("1", "a@x.cc", "older", "x.cc", "f", 1, -1), ("", "b@x.cc", "e", "x.cc", "f", 1, 0)], FINDINGS)
    second = spark.createDataFrame([("1", "a@x.cc", "new", "x.cc", "g", 1, 0), ("2", "c@x.cc", "c", "x.cc", "g", 1, 0)], FINDINGS)
    assert sinks.upsert_findings(first, root, sinks.RAW, ["seq"]) == 1
    assert sinks.upsert_findings(second, root, sinks.RAW, ["seq"]) == 2
    after = rows(sinks.read_findings(spark, root).select("id", "email_context"), "id")
    assert after == [("", "e"), ("1", "new"), ("2", "c")]
    assert sinks.upsert_findings(second, root, sinks.RAW, ["seq"]) == 3
    assert rows(sinks.read_findings(spark, root).select("id", "email_context"), "id") == after
    (Path(root) / "data-9").mkdir()
    assert sinks.latest_version(spark, root) == 3


def test_an_upsert_writes_its_batch_only(spark, tmp_path, monkeypatch):
    """Bytes written go with the batch, a lookup skips by Bloom filter, and merging runs changes no row."""
    root = tmp_path / "index"
    rows_of = lambda ids, mark: spark.createDataFrame([(f"{k:040x}", f"u{k}@x.cc", f"{mark} {k}" * 20, "x.cc", "f", 1, 0) for k in ids], FINDINGS)
    size = lambda: {p: p.stat().st_size for p in root.rglob("*.parquet")}
    monkeypatch.setattr(sinks, "LEAST_BYTES", 0)
    sinks.upsert_findings(rows_of(range(20_000), "base"), str(root), sinks.RAW, ["seq"])
    before, want = size(), {k: "base" for k in range(20_000)}
    for n in range(12):
        ids = [n, 20_000 + n, 30_000]
        sinks.upsert_findings(rows_of(ids, f"b{n}"), str(root), sinks.RAW, ["seq"])
        want |= {k: f"b{n}" for k in ids}
        assert all(size()[p] == s for p, s in before.items())
    added = sum(size().values()) - sum(before.values())
    assert added < sum(before.values()) / 2
    assert len(sinks._runs(spark, str(root), 13)) <= sinks.MOST_RUNS + 1
    got = {int(r.id, 16): r.email_context.split(" ")[0] for r in sinks.read_findings(spark, str(root)).collect()}
    assert got == want
    sinks.upsert_findings(rows_of(range(15_000), "new"), str(root), sinks.RAW, ["seq"])
    assert len(sinks._runs(spark, str(root), 14)) == 1
    got = {int(r.id, 16): r.email_context.split(" ")[0] for r in sinks.read_findings(spark, str(root)).collect()}
    assert got == want | {k: "new" for k in range(15_000)}


def test_upsert_without_success_markers(spark, tmp_path):
    """No version is lost, and of two writers from one version the second fails."""
    root = str(tmp_path / "index")
    batch = lambda key: spark.createDataFrame([(key, "a@x.cc", "c", "x.cc", "f", 1, 0)], FINDINGS)
    marks = spark.sparkContext._jsc.hadoopConfiguration()
    marks.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        assert [sinks.upsert_findings(batch(k), root, sinks.RAW, ["seq"]) for k in ("1", "2")] == [1, 2]
    finally:
        marks.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows(sinks.read_findings(spark, root).select("id"), "id") == [("1",), ("2",)]
    with pytest.raises(RuntimeError, match="another writer"):
        sinks._publish(spark, root, 2, "data-x")


@pytest.mark.parametrize("key", ["sesame-7391", "k" * 100])
def test_keys_stand_in_no_plan(spark, key):
    table = spark.createDataFrame([("é@x.cc",), ("",), (None,)], "email string")
    made = table.select(sinks.Protection(key).pseudonym(F.col("email")).alias("email"))
    assert [r.email for r in made.collect()] == [hmac.new(key.encode(), "é@x.cc".encode(), "sha256").hexdigest(), "", None]
    shown = made._jdf.queryExecution().toString() + repr(sinks.Protection(key))
    pads = [bytes(k ^ mix for k in key.encode()) for mix in (0, 0x36, 0x5C)]
    assert key not in shown and not any(p.hex()[:20] in shown.lower() or str(list(p[:4]))[1:-1] in shown for p in pads)


def test_a_batch_of_records_counts_once(spark, tmp_path):
    root, columns = str(tmp_path / "records"), ", ".join(f"`{c}` string" for c in [*fv.IDENTITY_FIELDS, "FROM"])
    batch = lambda name: spark.createDataFrame([("ES", "A", None, name, "F", None, "Street", "7", "a.png")], columns)
    protection = sinks.Protection("k")
    assert [sinks.append_records(batch("N"), root, protection, b) for b in ("one", "one", "two", "one")] == [True, False, True, False]
    (Path(root) / "data-left-by-a-run-that-died").mkdir()
    got = sinks.read_records(spark, root).collect()
    hashed = lambda v: hmac.new(b"k", v, "sha256").hexdigest()
    assert [(r["Country"], r["Name"], r["Date_of_Birth"], r["Address"], r["ID_Number"]) for r in got] == [("ES", hashed(b"N"), None, hashed(b"Street"), hashed(b"7"))] * 2


def test_sources_are_attached_once(spark):
    found = spark.createDataFrame([("a", 1), ("b", 0), ("c", 2), ("d", 1), ("e", 9)], "id string, id_source int")
    sources = spark.createDataFrame(
        [("old", "2024", 1), ("new", "2025", 1), ("bad", "2025", 0), ("worse", "2025", 0), ("two", "2025", 2), ("two", "2025", 2)],
        "post_title string, indexed string, id int",
    )
    assert rows(joins.attach_source(found, sources).select("id", "post_title"), "id") == [("a", "new"), ("c", "two"), ("d", "new")]
    _, left_out = joins.latest_sources(sources)
    assert rows(left_out.select("post_title"), "post_title") == [("bad",), ("old",), ("worse",)]


def test_protected_output_holds_no_address(spark, tmp_path):
    table = spark.createDataFrame([("1", "a@x.cc", "call a@x.cc or b@y.example.com", "x.cc", "f", 1, 0)], FINDINGS).drop("seq")
    path = str(tmp_path / "out")
    sinks.write_findings(table, path, sinks.Protection("k"))
    got = spark.read.parquet(path).first()
    assert got.email == hmac.new(b"k", b"a@x.cc", "sha256").hexdigest() and got.id == hmac.new(b"k", b"1", "sha256").hexdigest()
    assert not re.search("@", got.email_context) and got.domain == "x.cc"


def test_register_sources(spark):
    names = [n for n in fv.SOURCE_FIELDS if n != "indexed"]
    values = ["  title\n", "g", " ", "d", "w", "p", None, " 12 "]
    table = spark.createDataFrame([tuple(values), tuple(values[:-1] + ["abc"])], ", ".join(f"{n} string" for n in names))
    got = sinks.register_sources(table, F.lit("now")).collect()
    assert [r.id for r in got] == [12, 0] and got[0].post_title == "title" and got[0].discovered == "now" and got[0].country == ""


def test_files_and_lines(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.TXT").write_bytes(b"one\r\ntwo\xff a@b.cc\rthree\n")
    big = "".join(f"line {n} u{n}@example.com\n" for n in range(3000))
    (tmp_path / "big.txt").write_text(big)
    listed = rows(fs.list_files(spark, str(tmp_path)).select("name", "ext", "size"), "name")
    assert listed == [("a.TXT", "txt", 23), ("big.txt", "txt", len(big))]
    whole = fs.read_texts(spark, str(tmp_path), "*.TXT")
    assert rows(fs.read_lines(whole, "path", "text").select("line_no", "line"), "line_no") == [(1, "one"), (2, "two a@b.cc"), (3, "three")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        pieces = fs.read_pieces(spark, str(tmp_path), "big.txt")
        assert pieces.select(F.spark_partition_id()).distinct().count() > 1
        found = lanes.text_lane(pieces)
        assert found.count() == 3000
        assert found.where("email = 'u7@example.com'").first().origin == "big.txt"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    parted = lanes.text_lane(fs.read_pieces(spark, str(tmp_path), "*.TXT"))
    assert rows(parted.select("email", "email_context")) == [("a@b.cc", "two a@b.cc")]


def test_first_line_of_an_address_when_carriage_returns_part_lines(spark):
    files = spark.createDataFrame([(1, "u@example.com one\rv@example.com u@example.com two\r\nu@example.com three")], "doc int, text string")
    assert rows(text_lane(files).select("email", "email_context"), "email") == [
        ("u@example.com", "u@example.com one"), ("v@example.com", "v@example.com u@example.com two")]


@pytest.mark.parametrize("cut", [1000, 1 << 20])
def test_digests_do_not_depend_on_splits(spark, tmp_path, cut):
    rng = random.Random(4)
    lines = [f"line {rng.randrange(50)} u{n % 9}@example.com".encode() for n in range(300)]
    swapped = [*lines[:20], lines[21], lines[20], *lines[22:]]
    assert swapped != lines
    files = {
        "a": b"\n".join(lines) + b"\n", "b": b"\n".join(lines) + b"\n", "open": b"\n".join(lines), "crlf": b"\r\n".join(lines) + b"\r\n",
        "swapped": b"\n".join(swapped) + b"\n", "odd": b"\n".join([*lines[:-1], lines[-1] + b"\xff"]) + b"\n",
        # Each line feed moves across the end of another line.
        "moved": b"\n".join([lines[0] + lines[1][:1], lines[1][1:], *lines[2:]]) + b"\n", "empty": b"", "blank": b"\n", "twice": b"\n\n",
    }
    for name, content in files.items():
        (tmp_path / f"{name}.txt").write_bytes(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        pieces = fs.read_pieces(spark, str(tmp_path))
        digests = {r["path"].split("/")[-1][:-4]: r["digest"] for r in lanes.file_digests(lanes.split_findings(pieces)).collect()}
        assert digests["a"] == digests["b"] and len(set(digests.values())) == len(digests) - 1 == len(files) - 2
        whole = spark.createDataFrame([(n, bytearray(c)) for n, c in files.items() if c.strip()], "doc string, bytes binary").selectExpr("doc", "cast(bytes as string) as text")
        same = lanes.file_digests(lanes.split_findings(fs.cut_pieces(whole, "doc", "text"))).collect()
        # Texts are decoded already, so what did not decode is another text.
        assert {r["path"]: r["digest"] for r in same if r["path"] != "odd"} == {n: digests[n] for n in files if files[n].strip() and n != "odd"}
        kept = [r.origin for r in lanes.text_lane(pieces).select("origin").distinct().collect()]
        assert sorted(kept) == ["a.txt", "crlf.txt", "moved.txt", "odd.txt", "open.txt", "swapped.txt"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bytes_decide_copies_and_csv_decoding(spark, tmp_path):
    for name, content in (("a.txt", b"u@example.com\xff"), ("b.txt", b"u@example.com\xff"), ("c.txt", b"u@example.com"),
                          ("good.csv", b"name\nu@example.com\n"), ("bad.csv", b"name\nu@example.com\xff\n")):
        (tmp_path / name).write_bytes(content)
    found = lanes.text_lane(fs.read_pieces(spark, str(tmp_path), "*.txt"))
    assert rows(found.select("origin"), "origin") == [("a.txt",), ("c.txt",)]
    tables = fs.read_texts(spark, str(tmp_path), "*.csv")
    found = lanes.csv_lane(tables, "path", "text", "decodable").select("file").collect()
    assert [r.file.rsplit("/")[-1] for r in found] == ["good.csv"]


CSV_PARTS = ['"', '""', ",", "\n", "a", "x@y.example", '"a\nb"', '"a""b",', "\r\n", "\r", "é", ' "', "1,2\n", '\n"']


def test_state_at_the_end_of_a_line_is_that_of_the_records():
    """A text ends inside quotes exactly if what follows is taken for part of its last record."""
    rng = random.Random(8)
    for _ in range(5000):
        line = "".join(rng.choice([p for p in CSV_PARTS if "\n" not in p and "\r" not in p]) for _ in range(rng.randrange(9)))
        for start, inside in (("", False), ('"', True)):
            read = list(csv.reader(io.StringIO(start + line + "\n,,next\n", newline=""), strict=False))
            assert csv_pieces.ends_inside(line.encode(), inside) == (len(read) == 1), (start, line)


@pytest.mark.parametrize("cut", [23, 333])
def test_csv_in_splits_equals_csv_as_a_whole(spark, tmp_path, cut):
    rng = random.Random(cut)
    for n, header in enumerate(['\n', 'id,"note, x",b\n', "id,Email\n", "id,x\n", 'name,"a\nb"\n', "\r\nname\r\n"]):
        body = "".join(f'{i},"say ""{i}"" to\nu{i}@example.com",é{i},more\n' if i % 3 == 0 else f"{i},plain\n" for i in range(n // 3 * 12, 60))
        (tmp_path / f"f{n}.csv").write_bytes((header + body).encode())
    (tmp_path / "late.csv").write_text("id,x\n" + "1,2\n" * 10 + "1,u@example.com\n")
    (tmp_path / "never.csv").write_text('name,x\n1,"' + "u@example.com\n" * 30)
    for n in range(30):
        (tmp_path / f"r{n}.csv").write_bytes(("name,note\n" + "".join(rng.choice(CSV_PARTS) for _ in range(60))).encode())
    columns = ["file", "row_no", "email", "email_context", "id"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = lanes.csv_piece_lane(fs.read_pieces(spark, str(tmp_path), "*.csv")).select(*columns)
        got = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = lanes.csv_lane(fs.read_texts(spark, str(tmp_path), "*.csv"), "path", "text").select(*columns)
    assert len(got) > 60 and got == sorted(map(tuple, whole.collect()))


def test_findings_unique_after_index(spark):
    texts = [(n, f"user{n % 7}@Example.com line {n % 3}") for n in range(60)]
    files = spark.createDataFrame(texts, "doc int, text string")
    one = index.index_rows(text_lane(files), "txt", F.concat(F.col("file").cast("string"), F.lit(".json")), F.lit(1))
    both = index.index_all(one, one)
    assert both.count() == both.select("id").distinct().count() == 21
    row = both.first()
    assert row.email == row.email.lower() and row.domain == "example.com" and row["from"].endswith(".json")
