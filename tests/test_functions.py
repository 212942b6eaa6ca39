"""Column functions against Python's own regular expressions, csv, json and string methods."""

import csv
import io
import json
import os
import random
import re
import time
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions import emails as em
from exposcan.functions import ids
from exposcan.functions import json_text as js
from exposcan.functions import line_contexts as lc
from exposcan.functions import markup as mk
from exposcan.functions import tabular as tab
from exposcan.functions import text as tx
from exposcan.sources.records import read_records


def texts_of(tokens, count, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(tokens) for _ in range(rng.randint(0, length))) for _ in range(count)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)


def value(spark, text, function):
    return spark.createDataFrame([(text,)], "t string").select(function(F.col("t")).alias("v")).first()["v"]


def universal(text):
    return text.replace("\r\n", "\n").replace("\r", "\n")


def test_patterns_equal_python(spark):
    tokens = ["a", "b", ".", "@", '"', "\\", "[", "]", " ", "é", "$1", chr(0xFDD0), "中", "\n", "\r", "|", "%", "co", "a@b.cc", '"x"@y.z', "😀", "<", "-", "..", "@@"]
    texts = texts_of(tokens, 8000, 30, 1)
    c = F.col("t")
    rows = frame(spark, texts).select(
        "i", em.rfc_emails(c).alias("x1"), em.rfc_emails_relaxed(c).alias("x2"), em.simple_emails(c).alias("x3"),
        em.has_email(c).alias("has"), em.email_offsets(c).alias("offsets"), em.emails_in_context(c, 7).alias("context"),
        tx.strip(c).alias("stripped"), tx.lines_of(c).alias("lines"), tx.first_lines(c, 2).alias("head"),
    ).collect()
    for r in rows:
        text = texts[r.i]
        found = list(re.finditer(fv.RFC_EMAIL, text))
        assert r.x1 == [m.group() for m in found]
        assert r.x2 == [m.group() for m in re.finditer(fv.RFC_EMAIL_RELAXED, text)]
        assert r.x3 == re.findall(fv.SIMPLE_EMAIL, text)
        assert r.has == bool(found)
        assert [tuple(o) for o in r.offsets] == [(m.group(), m.start(), m.end()) for m in found]
        assert [(w.email, w.before, w.after) for w in r.context] == [
            (m.group(), text[max(0, m.start() - 7):m.start()], text[m.end():m.end() + 7]) for m in found
        ]
        assert r.stripped == text.strip()
        assert r.lines == [line.rstrip("\n") for line in io.StringIO(universal(text))]
        assert r["head"] == "\n".join(universal(text).split("\n")[:2])


def test_addresses_of_lines_and_sentences_equal_python(spark):
    """Quoted parts and literals that go over the end of a line or sentence, and points at it."""
    tokens = ["a", ". ", ".", " ", "@", '"', "\\", "[", "]", "\n", "a@b.cc", '"x y"@y.z', '"x. y"@y.z', '".', '"@', "@[", "é", "a.b@c.d. "]
    for kept, seed in ((tokens, 11), ([t for t in tokens if "\n" not in t], 12)):
        texts = texts_of(kept, 4000, 25, seed)
        for r in frame(spark, texts).select("i", em.emails_in_context(F.col("t"), 9).alias("found")).collect():
            text = texts[r.i]
            assert [(w.email, w.before, w.after) for w in r.found] == [
                (m.group(), text[max(0, m.start() - 9):m.start()], text[m.end():m.end() + 9]) for m in re.finditer(fv.RFC_EMAIL, text)
            ]


def test_short_ways_equal_python(spark):
    """JSON strings, heads and sizes of texts that need no pattern, and of those that do."""
    tokens = ["a", "é", '"', "\\", "\\u", "u00E9", "中", "😀", "\x7f", "\x00", "\t", "\r", "\n", " ", "\u2003", "z/"]
    texts = [*texts_of(tokens, 4000, 12, 13), "", "plain", "é", "\\", "\\u00C9", "É\\"]
    c = F.col("t")
    for r in frame(spark, texts).select("i", js.json_quote(c).alias("json"), tx.first_lines(c, 2).alias("head"), tx.lines_of(c).alias("lines"),
                                        tx.newline_to_space(c).alias("spaced"), tx.stripped_size(c).alias("size")).collect():
        text = texts[r.i]
        assert r.json == json.dumps(text)
        assert r["head"] == "\n".join(universal(text).split("\n")[:2])
        assert r.lines == [line.rstrip("\n") for line in io.StringIO(universal(text))]
        assert r.spaced == text.replace("\n", " ")
        blank = not text.strip()
        assert tuple(r.size) == (blank, len(text), len(text) - len(text.lstrip()), len(text) - len(text.rstrip()))


@pytest.mark.parametrize("direct_work", [0, 100_000])
def test_line_contexts_use_first_occurrence(spark, monkeypatch, direct_work):
    monkeypatch.setattr(lc, "_DIRECT_WORK", direct_work)
    tokens = ["a", "b", "ab", ".", "@", '"', " ", "é", "|", "co", "a@b.cc", "b@b.cc", "ab@b.ccc", "@b.cc", "-", "x.y", "'", "son@b.cc", "joson@b.cc"]
    texts = texts_of(tokens, 6000, 40, 2)
    valid = F.array_distinct(F.filter(em.rfc_emails(F.col("t")), em.valid_email))
    rows = frame(spark, texts).select("i", lc.line_contexts(F.col("t"), valid, 6).alias("c")).collect()
    for r in rows:
        text, expected = texts[r.i], {}
        for m in re.finditer(fv.RFC_EMAIL, text):
            email = m.group()
            if re.match(fv.STRICT_EMAIL, email):
                at = text.find(email)
                expected[email] = text[max(at - 6, 0):at + len(email) + 6].strip()
        assert {x.email: x.email_context for x in r.c} == expected


def test_csv_and_json_equal_python(spark):
    tokens = ["a", "b", ",", ",", '"', '""', "\n", "\n", " ", "é", "a@b.cc", "\\", "\r\n", "name", '","']
    texts = texts_of(tokens, 6000, 25, 3)
    rows = read_records(frame(spark, texts), "i", "t").select("file", "row_no", js.python_json(F.col("fields")).alias("j"))
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r.file, r.row_no)):
        got.setdefault(r.file, []).append(r.j)
    for i, text in enumerate(texts):
        assert got.get(i, []) == [json.dumps(d) for d in csv.DictReader(io.StringIO(universal(text)))], text


def test_json_text(spark):
    values = [{"a": 1, "b": [1, {"c": "x: y, z"}], "é": None, "t": True, "f": 1.5, "e": 'é"\\  '}, {}, {"k": {}}, {"a": "\\u00E9"}]
    for v in values:
        for separators in ((",", ":"), (", ", ": ")):
            text = json.dumps(v, ensure_ascii=False, separators=separators)
            assert value(spark, text, lambda c: js.python_json_text(js.one_json_value(c))) == json.dumps(v)
    for text in ['{"a":1}]', '{"a":1}] junk', "1],[2", '1,"x"] junk', '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "{a:1}", "{'a':1}", "", '{"a":1,}', "nope"]:
        assert value(spark, text, js.valid_json) is False
    for text in ['é"\\u00E9 \x01 \x7f 中😀/', "a\tb\n", "", "\\u00e9", "x\\\\u00E9é"]:
        assert value(spark, text, js.json_quote) == json.dumps(text)


@pytest.mark.parametrize("reply, block", [
    ('x {"a":{"b":1}} y', '{"a":{"b":1}}'), ("}{", None), ("none", None), ('```json\n{"a":1}\n```', '{"a":1}'), ("{", None), ("a}b{c}", "{c}"),
])
def test_json_block(spark, reply, block):
    assert value(spark, reply, js.json_block) == block


@pytest.mark.parametrize("xml, text", [
    ("<a>foo<![CDATA[bar@x.com<b>&amp;]]>baz</a>", "foobar@x.com<b>&amp;baz"),
    ("<a>x<!--c<d>--><e/>y<?pi z?>w</a>", "x y w"),
    ('<a><b>1</b>t<b t="x>y">2</b></a>', "1 t 2"),
    ("<a>&lt;&#65;&amp;lt;x&#x1F600;</a>", "<A&lt;x😀"),
    ('<?xml version="1.0"?>\n<!-- c -->\n<a>q\n</a>\n<!-- d -->\n', "q "),
    ("<d>email a@b.cc</d><e/>", None), ("<d/><e>x</e>", None), ("<d><e/>x</d>", "x"),
    ('<!DOCTYPE a [<!ENTITY who "a@b.cc"> <!ENTITY b \'x\'>]><a>mail &who;&b;</a>', "mail a@b.ccx"),
    ('<!DOCTYPE a [<!ENTITY x "&y;"><!ENTITY y "z">]><a>&x;</a>', None),
    ("<a><b></a>", None), ("plain", None), ("<a/>junk", None), ("<a>&nope;</a>", None), ("<a></a>", ""),
])
def test_xml_text(spark, xml, text):
    assert value(spark, xml, mk.xml_text) == text


def test_xml_that_does_not_parse_costs_its_own_row(spark):
    """Mutated documents: a text exactly if Python's parser takes the document, and never a failed job."""
    rng = random.Random(11)
    parts = ["<a>", "</a>", "<b x='1'>", "</b>", "<c/>", "text", "&amp;", "&#65;", "&#0;", "&nope;", "<!-- c -->", "<!-- a -- b -->", "<![CDATA[<q>]]>", "]]>", "<?pi y?>", " ", "\n", "é", "<", ">", "&",
             '<d x="1" x="2"/>', "<e x=1/>", "<?xml version='1.0'?>", "<!DOCTYPE a>", "<g x='<'/>", "\x01", "</_", "<![CDATA["]
    docs = ["<r>" + "".join(rng.choice(parts) for _ in range(rng.randrange(6))) + rng.choice(["</r>"] * 5 + ["", "</r><r/>", "</r>x"]) for _ in range(3000)]
    docs += ["<a><![CDATA[1]]><![CDATA[2]]><!-- <![CDATA[ 3 ]]> -->4</a>", "", " ", "<a/>\n<!-- z -->\n", '\ufeff<?xml version="1.0" encoding="UTF-8"?><a>x</a>']
    frame = spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "k int, xml string")
    got = {r.k: (r.text, r.good) for r in frame.select("k", mk.xml_text(F.col("xml")).alias("text"), mk.well_formed_xml(F.col("xml")).alias("good")).collect()}
    parsed, wrong = 0, []
    for k, doc in enumerate(docs):
        try:
            want = "".join(ElementTree.fromstring(doc.lstrip("\ufeff").encode()).itertext())
        except ElementTree.ParseError:
            want = None
        text, good = got[k]
        if not good == (text is not None) == (want is not None) or want is not None and text.replace(" ", "") != want.replace(" ", "").replace("\n", ""):
            wrong.append((doc, text, want))
        parsed += want is not None
    assert wrong == [] and parsed > 300


def test_entities_cannot_blow_up_a_document(spark):
    bomb = '<!DOCTYPE a [<!ENTITY e "' + "x" * 100_000 + '">]><a>' + "&e;" * 1_000 + "</a>"
    assert value(spark, bomb, mk.xml_text) is None and value(spark, bomb, mk.well_formed_xml) is False


@pytest.mark.parametrize("name", ["a.txt", "A.TXT", ".bashrc", "..x", "x.", "a.b.c", "d.d/file", "d/.h.txt", "x..y", "...", "", "d/", "..a.b"])
def test_names_equal_os_path(spark, name):
    row = spark.createDataFrame([(name,)], "t string").select(
        ids.base_name(F.col("t")), ids.file_ext(F.col("t")), ids.file_stem(F.col("t"))).first()
    base = os.path.basename(name)
    assert tuple(row) == (base, os.path.splitext(name)[1].lower().lstrip("."), os.path.splitext(base)[0])


@pytest.mark.parametrize("raw", [b"abc\xffd\xe2\x82A\xef\xbf\xbdz", b"ok \xc3\xa9", b"\xf0\x9f\x98", b"\xed\xa0\x80x"])
def test_undecodable_bytes_are_dropped(spark, raw):
    row = spark.createDataFrame([(bytearray(raw),)], "b binary").select(tx.valid_utf8(F.col("b").cast("string"))).first()
    assert row[0] == raw.decode("utf-8", "ignore")


@pytest.mark.parametrize("text, number", [("12", 12), (" 12 ", 12), ("abc", 0), ("", 0), ("1_000", 1000), ("+5", 5), ("1.5", 0), ("1__0", 0)])
def test_parse_int(spark, text, number):
    assert value(spark, text, ids.parse_int) == number


@pytest.mark.parametrize("text, x1, x2, x3", [
    ("a.b@mail.example.com", ["a.b@mail.example"], ["a.b@mail.example"], ["a.b@mail.example.com"]),
    ("x|a@example.com", ["a@example.com"], ["x|a@example.com"], ["a@example.com"]),
    ("root@localhost", [], [], []),
    ("o'neil@example.com", ["o'neil@example.com"], ["o'neil@example.com"], ["neil@example.com"]),
])
def test_address_cases(spark, text, x1, x2, x3):
    assert value(spark, text, em.rfc_emails) == x1
    assert value(spark, text, em.rfc_emails_relaxed) == x2
    assert value(spark, text, em.simple_emails) == x3


def test_strict_check_and_domain(spark):
    assert value(spark, "o'neil@example.com", em.valid_email) is False
    assert value(spark, "A@EXAMPLE.COM", ids.email_domain) == "example.com"
    assert value(spark, "plain", ids.email_domain) == ""


def test_mask_removes_every_address(spark):
    text = 'a.b@mail.example.com, "q q"@x.example and o\'neil@y.example.org'
    assert value(spark, text, em.mask_emails) == "[email], [email] and o'[email]"


def test_record_fields(spark):
    text = 'id,first,second\n1,Ann <a@example.com>,b@example.com\n'
    df = read_records(spark.createDataFrame([("x", text)], "i string, t string"), "i", "t").withColumnRenamed("fields", "f")
    first = df.select(tab.first_email_field(F.col("f"), whole_cell=False).alias("v")).first()["v"]
    whole = df.select(tab.first_email_field(F.col("f"), whole_cell=True).alias("v")).first()["v"]
    assert tuple(first) == ("first", "a@example.com")
    assert tuple(whole) == ("first", "Ann <a@example.com>")
    context = df.select(js.python_json(tab.record_context(F.col("f"), F.lit("first"))).alias("v")).first()["v"]
    assert context == json.dumps({"id": "1", "second": "b@example.com"})


@pytest.mark.parametrize("text", [
    "@" + "A" * 500_000, "@" + "a." * 250_000, '@"' + "x" * 500_000, "@\"" + '\\"a' * 150_000, " " * 500_000 + "@",
])
def test_hostile_texts_take_linear_time(spark, text):
    start = time.time()
    assert value(spark, text, em.rfc_emails) == []
    assert value(spark, text, em.simple_emails) == []
    assert value(spark, text, lambda c: F.size(em.emails_in_context(c, 500))) == 0
    assert value(spark, text, lambda c: F.length(tx.strip(c))) == len(text.strip())
    assert time.time() - start < 30


def test_many_addresses_on_one_line(spark):
    line = " ".join(f"user{i}@example{i % 7}.com," for i in range(20_000))
    start = time.time()
    valid = F.array_distinct(F.filter(em.rfc_emails(F.col("t")), em.valid_email))
    rows = spark.createDataFrame([(line,)], "t string").select(F.explode(lc.line_contexts(F.col("t"), valid)).alias("h")).select("h.*").collect()
    assert len(rows) == 20_000
    for r in rows[::997]:
        at = line.find(r.email)
        assert r.email_context == line[max(at - 150, 0):at + len(r.email) + 150].strip()
    assert time.time() - start < 60
