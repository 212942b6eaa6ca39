"""One query per operator, named by its id in the survey, each with the SQL it must equal."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.sql import STRICT, X1, X2, X3, domain, matches, py_dict, py_string, strip, window
from exposcan import fixed_values as fv
from exposcan.functions import emails as em
from exposcan.functions import ids
from exposcan.functions import json_text as js
from exposcan.functions import tabular as tab
from exposcan.functions import text as tx
from exposcan.functions.line_contexts import line_contexts
from exposcan.operators import dedup, joins, ordered, report, routing, sinks, sniff
from exposcan.plans import identity, index, lanes, organise
from exposcan.plans.folder import run_folder
from exposcan.sources import files as fs
from exposcan.sources import findings_json as fj
from exposcan.sources import markup, records
from exposcan.sources.listing import list_all_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def big(name: str):
    return F.col(name).cast("bigint").alias(name)


def source_id():
    """The number in a document's source name."""
    return F.regexp_extract("source", "([0-9]+)", 1).cast("int")


SOURCE_ID = "CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER)"
TAGGED = f"(SELECT *, 'u' || doc || '.' || lang || '@' || source || '.Example.org' AS address FROM {t.TEXTS})"


def tagged(spark, sf):
    doc = F.col("doc").cast("string")
    address = F.concat(F.lit("u"), doc, F.lit("."), F.col("lang"), F.lit("@"), F.col("source"), F.lit(".Example.org"))
    return t.texts(spark, sf).withColumn("address", address)


# --- sources ----------------------------------------------------------------------------


@query("s1_read_lines", f"SELECT doc, line_no, line FROM {t.LINES}")
def _(spark, sf):
    return fs.read_lines(t.texts(spark, sf), "doc", "text").select("doc", big("line_no"), "line")


@query("s2_read_records", """SELECT doc_id AS file, CAST(1 AS BIGINT) AS row_no, CAST(pos AS BIGINT) AS pos, name, value FROM (
 SELECT doc_id, 0 AS pos, 'doc_id' AS name, CAST(doc_id AS VARCHAR) AS value FROM documents
 UNION ALL SELECT doc_id, 1, 'lang', lang FROM documents UNION ALL SELECT doc_id, 2, 'source', source FROM documents
 UNION ALL SELECT doc_id, 3, 'the "text", whole', regexp_replace(text, '\\r\\n?', chr(10), 'g') FROM documents)""")
def _(spark, sf):
    body = F.concat(
        F.lit('doc_id,lang,source,"the ""text"", whole"\n'), F.col("doc_id").cast("string"), F.lit(","), "lang",
        F.lit(","), "source", F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"\n'),
    )
    found = records.read_records(t.documents(spark, sf).select("doc_id", body.alias("csv")), "doc_id", "csv")
    return found.select("file", "row_no", F.posexplode("fields").alias("pos", "field")).select(
        "file", "row_no", big("pos"), "field.name", "field.value"
    )


GAP = "c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey % 5 = 3"


@query("s3_sheet_records", f"""SELECT c_mktsegment AS file, c_custkey AS row_no, CAST(pos AS BIGINT) AS pos, name, value, raw FROM (
 SELECT c_mktsegment, c_custkey, 0 AS pos, 'c_custkey' AS name, CAST(c_custkey AS VARCHAR) AS value, true AS raw FROM customer
 UNION ALL SELECT c_mktsegment, c_custkey, 1, 'c_name', c_name, false FROM customer
 UNION ALL SELECT c_mktsegment, c_custkey, 2, 'c_acctbal', CASE WHEN c_acctbal = 73.0 THEN '' ELSE CAST(
 round(c_acctbal) * CASE c_custkey % 3 WHEN 0 THEN 1e18 WHEN 1 THEN 1e-9 ELSE 1.0 END AS VARCHAR) END, c_acctbal <> 73.0 FROM customer
 UNION ALL SELECT c_mktsegment, c_custkey, 3, 'c_nationkey', CASE WHEN {GAP} THEN '' WHEN bool_or({GAP}) OVER (PARTITION BY c_mktsegment)
 THEN c_nationkey || '.0' ELSE CAST(c_nationkey AS VARCHAR) END, NOT ({GAP}) FROM customer)""")
def _(spark, sf):
    """The last column has gaps in two of the files."""
    power = F.when(F.col("c_custkey") % 3 == 0, 1e18).when(F.col("c_custkey") % 3 == 1, 1e-9).otherwise(1.0)
    c = t.table(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") != 73.0, F.round("c_acctbal") * power))
    c = c.withColumn("c_nationkey", F.when(~F.expr(GAP), F.col("c_nationkey")))
    found = records.sheet_records(c, F.col("c_mktsegment"), F.col("c_custkey"), ["c_custkey", "c_name", "c_acctbal", "c_nationkey"])
    return found.select("file", "row_no", F.posexplode("fields").alias("pos", "field")).select(
        "file", "row_no", big("pos"), "field.name", "field.value", "field.raw"
    )


@query("s4_xml_text", f"SELECT doc, text FROM {t.XML_DOCS}")
def _(spark, sf):
    return markup.read_xml_text(t.xml_docs(spark, sf), "doc", "xml")


@query("s5_page_text", f"SELECT doc, page_no, text FROM {t.PAGES}")
def _(spark, sf):
    return markup.page_text(t.texts(spark, sf), "doc", "text").select("doc", big("page_no"), "text")


@query("s6_block_text", "SELECT conv_id AS doc, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id")
def _(spark, sf):
    return markup.block_text(t.table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query("s7_read_keyed_findings", f"""SELECT doc AS file, address AS email, text AS email_context, sha1(text) AS id, source AS origin FROM {TAGGED}
 UNION ALL SELECT doc, 'second@' || lang, source, '', '' FROM {TAGGED}""")
def _(spark, sf):
    first = F.struct(F.col("text").alias("email_context"), F.sha1("text").alias("ID"), F.col("source").alias("FROM"))
    none = F.lit(None).cast("string")
    second = F.struct(F.col("source").alias("email_context"), none.alias("ID"), none.alias("FROM"))
    json = F.to_json(F.create_map(F.col("address"), first, F.concat(F.lit("second@"), "lang"), second))
    # An earlier member of the same key and one that is no object: the last counts, the odd one costs only itself.
    json = F.concat(F.lit('{"odd@x.example":"text","second@'), "lang", F.lit('":{"email_context":"earlier"},'), F.substring(json, F.lit(2), F.length(json)))
    return fj.read_keyed_findings(tagged(spark, sf).select("doc", json.alias("json")), "doc", "json")


@query("s8_read_object_findings", f"""SELECT doc AS file, address AS email, text AS email_context, sha1(lower(address) || text) AS id FROM {TAGGED}
 UNION ALL SELECT doc, 'second@' || lang, '', sha1('second@' || lang) FROM {TAGGED}""")
def _(spark, sf):
    none = F.lit(None).cast("string")
    json = F.to_json(F.create_map(
        F.col("address"), F.struct(F.col("text").alias("email_context")),
        F.concat(F.lit("second@"), "lang"), F.struct(none.alias("email_context")),
    ))
    return fj.read_object_findings(tagged(spark, sf).select("doc", json.alias("json")), "doc", "json")


ARRAY_CONTEXT = py_dict(("doc", "CAST(doc AS VARCHAR)"), ("text", py_string("text")), ("none", "'null'"))


@query("s9_read_array_findings", f"""SELECT doc AS file, CAST(seq AS BIGINT) AS seq, email, email_context, sha1(lower(email) || email_context) AS id FROM (
 SELECT doc, 0 AS seq, address AS email, {ARRAY_CONTEXT} AS email_context FROM {TAGGED}
 UNION ALL SELECT doc, 2, lang || '@x.example', 'None' FROM {TAGGED}
 UNION ALL SELECT doc, 3, lang || '@y.example', source FROM {TAGGED})""")
def _(spark, sf):
    quoted = F.get_json_object(F.to_json(F.struct("text")), "$")
    full = F.concat(F.lit('{"doc":'), F.col("doc").cast("string"), F.lit(","), F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(',"none":null}'))
    json = F.concat(
        F.lit('[{"email":"'), "address", F.lit('", "email_context": '), full, F.lit('},\n{"email":"lost@x.example"},{"email":"'), "lang",
        F.lit('@x.example","email_context":null},{"email_context":"'), "source", F.lit('","email":"'), "lang", F.lit('@y.example"}]'),
    )
    return fj.read_array_findings(tagged(spark, sf).select("doc", json.alias("json")), "doc", "json").withColumn("seq", big("seq"))


IDENTITY_NAMES = "country, authority, expires, name, gender, born, address, number"
AS_SHORT = ["country", "authority", "expires", "name", "gender", "born", "address", "number"]


def short(frame, *more):
    return frame.select(*more, *[F.col(f"`{a}`").alias(b) for a, b in zip(fv.IDENTITY_FIELDS, AS_SHORT)])


@query("s10_read_identity_json", f"SELECT image AS file, {IDENTITY_NAMES} FROM {t.REPLIES} WHERE status IN ('skipped', 'indexed')")
def _(spark, sf):
    blocks = t.replies(spark, sf).select("image", js.json_block(F.col("reply")).alias("json"))
    return short(fj.read_identity_json(blocks, "image", "json"), "file")


NAMED = f"(SELECT doc_id AS doc, 'File' || doc_id || {t.cycle_sql(t.SUFFIXES, 'doc_id')} AS name FROM documents)"


@query("s12_select_json", f"""SELECT doc, name, name LIKE '%.json' AS json, lower(name) LIKE '%.csv' AS csv,
 regexp_matches(lower(name), '\\.xlsx?$') AS sheet, lower(name) LIKE '%.xml' AS xml, lower(name) LIKE '%.pdf' AS pdf,
 regexp_matches(lower(name), '\\.(doc|ppt)x?$') AS office FROM {NAMED}""")
def _(spark, sf):
    name = F.concat(F.lit("File"), F.col("doc_id").cast("string"), t.cycle(t.SUFFIXES, F.col("doc_id")))
    named = t.documents(spark, sf).select(F.col("doc_id").alias("doc"), name.alias("name"))
    flags = [fs.has_suffix(F.col("name"), kind).alias(kind) for kind in fs.SUFFIXES]
    return named.select("doc", "name", fs.is_json_name(F.col("name")).alias("json"), *flags)


# --- filters ----------------------------------------------------------------------------


@query("f1_drop_small", f"SELECT path, size FROM {t.FILES} WHERE size >= 512")
def _(spark, sf):
    return routing.drop_small(t.files(spark, sf)).select("path", "size")


@query("f2_drop_links", f"SELECT path, size FROM {t.FILES} WHERE NOT is_link")
def _(spark, sf):
    return routing.drop_links(t.files(spark, sf)).select("path", "size")


BUCKETS = ", ".join(f"('{e}', '{b}')" for e, b in fv.BUCKET_OF_EXTENSION.items())
ROUTED = f"""(SELECT f.*, CASE WHEN f.ext = '' THEN 'Dir_texto' ELSE b.bucket END AS bucket
 FROM {t.FILES} f LEFT JOIN (VALUES {BUCKETS}) AS b(ext, bucket) ON f.ext = b.ext)"""


@query("f3_route_by_extension", f"SELECT path, ext, bucket FROM {ROUTED}")
def _(spark, sf):
    return routing.route_by_extension(t.files(spark, sf)).select("path", "ext", "bucket")


@query("f4_drop_unknown_extension", f"SELECT path, ext, bucket FROM {ROUTED} WHERE bucket IS NOT NULL")
def _(spark, sf):
    return routing.drop_unknown_extension(t.files(spark, sf)).select("path", "ext", "bucket")


HEADER = "CASE lang WHEN 'en' THEN 'id,\"Name\",x' WHEN 'de' THEN 'e-mail,id' ELSE 'id,note' END"
HEADED = f"(SELECT doc, lang, source, {HEADER} || chr(10) || text AS text FROM {t.TEXTS})"
HEADED_LINES = t.lines_sql(HEADED, "doc", "lang")
SNIFFED = f"""SELECT DISTINCT doc FROM {HEADED_LINES} WHERE lang = 'en' OR (line_no <= 10 AND regexp_matches(line, {X2}))"""


def headed(spark, sf):
    header = F.when(F.col("lang") == "en", 'id,"Name",x').when(F.col("lang") == "de", "e-mail,id").otherwise("id,note")
    return t.texts(spark, sf).withColumn("text", F.concat(header, F.lit("\n"), "text"))


@query("f5_sniff_csv", SNIFFED)
def _(spark, sf):
    return headed(spark, sf).where(sniff.sniff_csv_text(F.col("text"))).select("doc")


@query("f5_sniff_csv_lines", SNIFFED)
def _(spark, sf):
    return sniff.sniff_csv(fs.read_lines(headed(spark, sf), "doc", "text"))


@query("f6_sniff_sheet", f"SELECT DISTINCT doc AS file FROM {t.LINES} WHERE lang = 'fr' OR (line_no <= 10 AND regexp_matches(line, {X1}))")
def _(spark, sf):
    cell = lambda name: F.struct(name.alias("name"), F.col("line").alias("value"), F.lit(False).alias("raw"))
    title = F.when(F.col("lang") == "fr", "NAME").otherwise("Name of it")
    rows = t.lines(spark, sf).select(F.col("doc").alias("file"), F.col("line_no").alias("row_no"), F.array(cell(title)).alias("fields"))
    return sniff.sniff_sheet(rows)


@query("f7_sniff_xml", f"""SELECT doc, contains(lower(text), 'email')
 OR doc IN (SELECT doc FROM {t.LINES} WHERE line_no <= 10 AND regexp_matches(line, {X1})) AS kept FROM {t.TEXTS}""")
def _(spark, sf):
    return t.texts(spark, sf).select("doc", sniff.sniff_xml_text(F.col("text")).alias("kept"))


GATED = f"(SELECT DISTINCT doc FROM {t.PAGES} WHERE page_no <= 30 AND regexp_matches(text, {X1}))"


@query("f8_page_gate", f"SELECT doc FROM {GATED}")
def _(spark, sf):
    return sniff.page_gate(t.pages(spark, sf))


DOC_PAGES = """(SELECT doc_id AS doc, CAST(i AS BIGINT) AS page_no, ps[i] AS text FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i
 FROM (SELECT doc_id, string_split(text, chr(10)) AS ps FROM documents)))"""


@query("f9_digital_or_scanned_pdf", f"SELECT doc, length({strip('text')}) > 50 AS digital FROM (SELECT doc, string_agg(text, '' ORDER BY page_no) AS text FROM {DOC_PAGES} GROUP BY doc)")
def _(spark, sf):
    return sniff.paged_digital(markup.page_text(t.documents(spark, sf), "doc_id", "text"))


READ = """(SELECT * FROM (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY doc ORDER BY seq
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chars_before FROM {blocks}) WHERE chars_before <= 50)"""
DOC_BLOCKS = t.lines_sql("(SELECT doc_id AS doc, text FROM documents)", "doc")
DOC_BLOCKS = f"(SELECT doc, line_no AS seq, line AS text FROM {DOC_BLOCKS})"


@query("f9_digital_or_scanned_office", f"SELECT doc, length({strip('text')}) > 50 AS digital FROM (SELECT doc, string_agg(text, chr(10) ORDER BY seq) AS text FROM {READ.format(blocks=DOC_BLOCKS)} GROUP BY doc)")
def _(spark, sf):
    rows = fs.read_lines(t.documents(spark, sf), "doc_id", "text")
    return sniff.office_digital(rows.select("doc", F.col("line_no").alias("seq"), F.col("line").alias("text")))


TITLED = f"(SELECT doc_id AS doc, {t.cycle_sql(t.TITLES, 'doc_id')} || ' ' || lang || doc_id || '.Docx' AS name FROM documents)"
REVIEW = "contains(lower(name), 'hiring') AND regexp_matches(lower(name), 'cv|resume|passport')"


@query("f10_route_by_title", f"SELECT doc, CASE WHEN {REVIEW} THEN lower(name) ELSE name END AS name, {REVIEW} AS identity_review FROM {TITLED}")
def _(spark, sf):
    name = F.concat(t.cycle(t.TITLES, F.col("doc_id")), F.lit(" "), "lang", F.col("doc_id").cast("string"), F.lit(".Docx"))
    return routing.route_by_title(t.documents(spark, sf).select(F.col("doc_id").alias("doc"), name.alias("name")))


def found(spark, sf, extract):
    return t.texts(spark, sf).select("doc", F.posexplode(extract(F.col("text"))).alias("pos", "email"))


@query("f11_valid_email", f"""SELECT doc, pos, email, regexp_matches(email, {STRICT}) AS valid FROM (
 SELECT doc, pos, email FROM {matches(t.TEXTS, 'doc')} UNION ALL SELECT doc, -pos, email || chr(8232) FROM {matches(t.TEXTS, 'doc')})""")
def _(spark, sf):
    rows = found(spark, sf, em.rfc_emails)
    rows = rows.select("doc", (F.col("pos") + 1).cast("bigint").alias("pos"), "email")
    ended = rows.select("doc", (-F.col("pos")).alias("pos"), F.concat("email", F.lit("\u2028")).alias("email"))
    return rows.union(ended).withColumn("valid", em.valid_email(F.col("email")))


@query("f12_require_identity", f"SELECT image AS file, {IDENTITY_NAMES} FROM {t.REPLIES} WHERE status IN ('skipped', 'indexed') AND (name <> '' OR number <> '')")
def _(spark, sf):
    blocks = t.replies(spark, sf).select("image", js.json_block(F.col("reply")).alias("json"))
    return short(identity.require_identity(fj.read_identity_json(blocks, "image", "json")), "file")


def record_rows(spark, sf):
    """Records of language, text and source; the language cell holds an address for German."""
    cell = lambda name, value, raw=False: F.struct(F.lit(name).alias("name"), value.alias("value"), F.lit(raw).alias("raw"))
    mail = F.when(F.col("lang") == "de", F.concat("lang", F.lit("."), F.col("doc").cast("string"), F.lit("@mail.example.com"))).otherwise(F.col("lang"))
    return t.texts(spark, sf).select("doc", F.array(
        cell("doc", F.col("doc").cast("string"), True), cell("lang", mail), cell("text", F.col("text")), cell("source", F.col("source")),
    ).alias("fields"))


MAIL = "CASE WHEN lang = 'de' THEN lang || '.' || doc || '@mail.example.com' ELSE lang END"


@query("f13_has_email_field", f"SELECT doc, lang = 'de' OR regexp_matches(text, {X3}) AS csv, lang = 'de' OR regexp_matches(text, {X1}) AS sheet FROM {t.TEXTS}")
def _(spark, sf):
    return record_rows(spark, sf).select(
        "doc", tab.has_email_field(F.col("fields"), em.SIMPLE).alias("csv"), tab.has_email_field(F.col("fields"), em.RFC).alias("sheet")
    )


# Trailing data of all kinds is bad; repeated keys and space are not.
BROKEN = ["{}}", "{}, {}", "{}]", "{}] junk", "1],[2", "{}", " {} ", "[1, 2]", '{{"a":1,"a":2}}', "", "{} {}", "{},"]
GOOD = (5, 6, 7, 8)


@query("f14_quarantine_bad_json", f"""SELECT event_id, event_type, CASE WHEN event_id % {len(BROKEN)} IN {GOOD} THEN 'good' ELSE 'bad' END AS verdict FROM events""")
def _(spark, sf):
    forms = F.array(*[F.lit(form.replace("{}", "\x00").replace("{{", "{").replace("}}", "}")) for form in BROKEN])
    json = F.replace(F.get(forms, (F.col("event_id") % len(BROKEN)).cast("int")), F.lit("\x00"), F.col("props"))
    good, bad = report.quarantine(t.table(spark, sf, "events").withColumn("json", json), "json")
    tag = lambda frame, verdict: frame.select("event_id", "event_type", F.lit(verdict).alias("verdict"))
    return tag(good, "good").unionByName(tag(bad, "bad"))


# --- scalar functions -------------------------------------------------------------------


for _name, _extract, _pattern in (
    ("x1_rfc_emails", em.rfc_emails, X1), ("x2_rfc_emails_relaxed", em.rfc_emails_relaxed, X2), ("x3_simple_emails", em.simple_emails, X3),
):
    @query(_name, f"SELECT doc, pos, email FROM {matches(t.TEXTS, 'doc', pattern=_pattern)}")
    def _(spark, sf, extract=_extract):
        return found(spark, sf, extract).select("doc", (F.col("pos") + 1).cast("bigint").alias("pos"), "email")


@query("x4_email_offsets", f"SELECT doc, pos, email, start AS first, start + length(email) AS past FROM {matches(t.TEXTS, 'doc')}")
def _(spark, sf):
    rows = t.texts(spark, sf).select("doc", F.posexplode(em.email_offsets(F.col("text"))).alias("pos", "hit"))
    return rows.select("doc", (F.col("pos") + 1).cast("bigint").alias("pos"), "hit.email",
                       F.col("hit.start").cast("bigint").alias("first"), F.col("hit.end").cast("bigint").alias("past"))


@query("x5_first_email_field_csv", f"""SELECT doc, CASE WHEN lang = 'de' THEN 'lang' ELSE 'text' END AS field,
 CASE WHEN lang = 'de' THEN {MAIL} ELSE regexp_extract(text, {X3}, 0) END AS email FROM {t.TEXTS}""")
def _(spark, sf):
    rows = record_rows(spark, sf).select("doc", tab.first_email_field(F.col("fields"), whole_cell=False).alias("hit"))
    return rows.where(F.col("hit").isNotNull()).select("doc", F.col("hit.name").alias("field"), "hit.email")


@query("x5_first_email_field_sheet", f"""SELECT doc, CASE WHEN lang = 'de' THEN 'lang' ELSE 'text' END AS field,
 CASE WHEN lang = 'de' THEN {MAIL} ELSE text END AS email FROM {t.TEXTS}""")
def _(spark, sf):
    rows = record_rows(spark, sf).select("doc", tab.first_email_field(F.col("fields"), whole_cell=True).alias("hit"))
    return rows.where(F.col("hit").isNotNull()).select("doc", F.col("hit.name").alias("field"), "hit.email")


LINE_HITS = f"(SELECT DISTINCT doc, line_no, line, email FROM {matches(t.LINES, 'doc', 'line_no', text='line')} WHERE regexp_matches(email, {STRICT}))"
LINE_CONTEXT = strip(window("line", "(instr(line, email) - 1)", "length(email)", 150))


@query("x6a_line_context", f"SELECT doc, line_no, email, {LINE_CONTEXT} AS email_context FROM {LINE_HITS}")
def _(spark, sf):
    valid = F.array_distinct(F.filter(em.rfc_emails(F.col("line")), em.valid_email))
    rows = t.lines(spark, sf).where(F.col("line").contains("@"))
    return rows.select("doc", big("line_no"), F.explode(line_contexts(F.col("line"), valid)).alias("hit")).select("doc", "line_no", "hit.*")


TEXT_CONTEXT = f"translate({window('text', 'start', 'length(email)', 500)}, chr(10), ' ')"
XML_CONTEXT = strip(window("text", "start", "length(email)", 200))


@query("x6b_text_context", f"SELECT doc, pos, email, {TEXT_CONTEXT} AS email_context FROM {matches(t.TEXTS, 'doc')}")
def _(spark, sf):
    rows = lanes.context_findings(t.texts(spark, sf), "text", fv.TEXT_CONTEXT, "doc")
    return rows.select("doc", big("pos"), "email", tx.newline_to_space(F.concat("before", "email", "after")).alias("email_context"))


@query("x6c_xml_context", f"SELECT doc, pos, email, {XML_CONTEXT} AS email_context FROM {matches(t.TEXTS, 'doc')}")
def _(spark, sf):
    rows = lanes.context_findings(t.texts(spark, sf), "text", fv.XML_CONTEXT, "doc")
    return rows.select("doc", big("pos"), "email", tx.strip(F.concat("before", "email", "after")).alias("email_context"))


FIELDS = f"""SELECT doc, CAST(0 AS BIGINT) AS pos, 'doc' AS name, CAST(doc AS VARCHAR) AS value FROM {t.TEXTS}
 UNION ALL SELECT doc, 1, 'lang', {MAIL} FROM {t.TEXTS} UNION ALL SELECT doc, 2, 'text', translate(text, chr(10), ' ') FROM {t.TEXTS}
 UNION ALL SELECT doc, 3, 'source', source FROM {t.TEXTS}"""


@query("x7_clean_values", FIELDS)
def _(spark, sf):
    rows = record_rows(spark, sf).select("doc", F.posexplode(tab.clean_values(F.col("fields"))).alias("pos", "field"))
    return rows.select("doc", big("pos"), "field.name", "field.value")


@query("x8_record_context", f"SELECT doc, name, value FROM ({FIELDS}) WHERE name <> 'text'")
def _(spark, sf):
    kept = tab.record_context(tab.clean_values(F.col("fields")), F.lit("text"))
    return record_rows(spark, sf).select("doc", F.explode(kept).alias("field")).select("doc", "field.name", "field.value")


RECORD_JSON = py_dict(("doc", "doc"), ("lang", py_string(MAIL)), ("text", py_string("text")), ("source", py_string("source")))


@query("x9_python_json", f"SELECT doc, {RECORD_JSON} AS json FROM {t.TEXTS}")
def _(spark, sf):
    return record_rows(spark, sf).select("doc", js.python_json(F.col("fields")).alias("json"))


for _name, _function, _sql in (
    ("x10a_finding_id_text", ids.finding_id_text, "sha1(address || '_' || text)"),
    ("x10b_finding_id_doc", ids.finding_id_doc, "sha1(address || text)"),
    ("x10c_finding_id_index", ids.finding_id_index, "sha1(lower(address) || text)"),
):
    @query(_name, f"SELECT doc, {_sql} AS id FROM {TAGGED}")
    def _(spark, sf, function=_function):
        return tagged(spark, sf).select("doc", function(F.col("address"), F.col("text")).alias("id"))


@query("x11_email_domain", f"SELECT doc, {domain('address')} AS domain, {domain('text')} AS of_text, {domain('source')} AS of_plain FROM {TAGGED}")
def _(spark, sf):
    return tagged(spark, sf).select("doc", ids.email_domain(F.col("address")).alias("domain"),
                                    ids.email_domain(F.col("text")).alias("of_text"), ids.email_domain(F.col("source")).alias("of_plain"))


@query("x12_normalise_email", f"SELECT doc, lower(address) AS email FROM {TAGGED}")
def _(spark, sf):
    return tagged(spark, sf).select("doc", ids.normalise_email(F.col("address")).alias("email"))


@query("x13_provenance", f"SELECT doc, source || '.txt ' || source || '.txt.json' AS \"from\" FROM {t.TEXTS}")
def _(spark, sf):
    name = F.concat("source", F.lit(".txt"))
    return t.texts(spark, sf).select("doc", ids.keyed_provenance(name, F.concat(name, F.lit(".json"))).alias("from"))


PATHS = f"(SELECT doc_id AS doc, source || '.d/' || lang || '/.' || {t.cycle_sql(['a.Tar.GZ', 'b', 'c.', '.d.TXT', 'e x.Pdf'], 'doc_id')} AS dotted, source || '.d/' || {t.cycle_sql(['a.Tar.GZ', 'b', 'c.', 'd..TXT', 'e x.Pdf'], 'doc_id')} AS path FROM documents)"


@query("x14_file_names", f"""SELECT doc, split_part(path, '/', -1) AS base, lower(regexp_extract(split_part(path, '/', -1), '[^.].*\\.([^.]*)$', 1)) AS ext,
 regexp_replace(split_part(path, '/', -1), '\\.[^.]*$', '') AS stem,
 lower(regexp_extract(split_part(dotted, '/', -1), '[^.].*\\.([^.]*)$', 1)) AS dotted_ext FROM {PATHS}""")
def _(spark, sf):
    key = F.col("doc_id")
    path = F.concat("source", F.lit(".d/"), t.cycle(["a.Tar.GZ", "b", "c.", "d..TXT", "e x.Pdf"], key))
    dotted = F.concat("source", F.lit(".d/"), "lang", F.lit("/."), t.cycle(["a.Tar.GZ", "b", "c.", ".d.TXT", "e x.Pdf"], key))
    rows = t.documents(spark, sf).select(key.alias("doc"), path.alias("path"), dotted.alias("dotted"))
    return rows.select("doc", ids.base_name(F.col("path")).alias("base"), ids.file_ext(F.col("path")).alias("ext"),
                       ids.file_stem(F.col("path")).alias("stem"), ids.file_ext(F.col("dotted")).alias("dotted_ext"))


@query("x15_empty_to_null", f"SELECT image, nullif(born, '') AS born, nullif(expires, '') AS expires FROM {t.REPLIES} WHERE status IN ('skipped', 'indexed')")
def _(spark, sf):
    blocks = t.replies(spark, sf).select("image", js.json_block(F.col("reply")).alias("json"))
    rows = fj.read_identity_json(blocks, "image", "json")
    return rows.select(F.col("file").alias("image"), ids.empty_to_null(F.col("`Date of Birth`")).alias("born"), ids.empty_to_null(F.col("`Expiration Date`")).alias("expires"))


@query("x16_json_block", """SELECT event_id, props AS block, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events
 UNION ALL SELECT event_id, NULL, NULL FROM events""")
def _(spark, sf):
    events = t.table(spark, sf, "events")
    fenced = events.select("event_id", F.concat(F.lit("Here } it is:\n```json\n"), "props", F.lit("\n``` {done")).alias("reply"))
    bare = events.select("event_id", F.concat(F.lit("} none {"), "event_type").alias("reply"))
    block = js.json_block(F.col("reply"))
    return fenced.unionByName(bare).select("event_id", block.alias("block"), F.get_json_object(block, "$.k").alias("k"))


PADDED = "(chr(9) || chr(160) || text || chr(8195) || chr(12288) || chr(10))"


@query("x17_py_strip", f"SELECT doc, {strip(PADDED)} AS text FROM {t.TEXTS}")
def _(spark, sf):
    padded = F.concat(F.lit("\t" + chr(160)), "text", F.lit(chr(8195) + chr(12288) + "\n"))
    return t.texts(spark, sf).select("doc", tx.strip(padded).alias("text"))


@query("x18_alnum_id", f"SELECT doc, regexp_replace(text, '[^A-Za-z0-9]', '', 'g') AS id FROM {t.TEXTS}")
def _(spark, sf):
    return t.texts(spark, sf).select("doc", ids.alnum_id(F.col("text")).alias("id"))


@query("x19_content_sha1", "SELECT doc_id, sha1(text) AS sha1 FROM documents")
def _(spark, sf):
    return t.documents(spark, sf).select("doc_id", ids.content_sha1(F.col("text")).alias("sha1"))


@query("x20_iso_utc", """SELECT event_id, CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
 ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events""")
def _(spark, sf):
    return t.table(spark, sf, "events").select("event_id", ids.iso_utc(F.col("ts")).alias("iso"))


# --- aggregation and duplicates ---------------------------------------------------------


KEPT_COPIES = "(SELECT min(doc_id) AS file, sha1(text) AS sha1 FROM documents GROUP BY sha1(text))"


@query("a1_dedup_files", "SELECT file, sha1 FROM (SELECT doc_id AS file, sha1(text) AS sha1, row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def _(spark, sf):
    return dedup.dedup_files(t.documents(spark, sf), "doc_id", "text")


@query("a2_first_per_email", f"""SELECT doc, email, email_context FROM (SELECT doc, email, {LINE_CONTEXT} AS email_context,
 row_number() OVER (PARTITION BY doc, email ORDER BY line_no) AS n FROM {LINE_HITS}) WHERE n = 1""")
def _(spark, sf):
    rows = lanes.line_findings(t.lines(spark, sf), "doc", "line_no")
    return dedup.first_per_email(rows, ["doc", "email"], ["line_no"], F.col("email_context"))


PAGE_HITS = f"(SELECT *, {TEXT_CONTEXT} AS email_context FROM {matches(t.PAGES, 'doc', 'name', 'page_no')})"
LAST_HITS = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, email ORDER BY page_no DESC, pos DESC) AS n FROM {PAGE_HITS}) WHERE n = 1)"


@query("a3_last_per_email", f"SELECT doc, email, email_context FROM {LAST_HITS}")
def _(spark, sf):
    rows = lanes.context_findings(t.pages(spark, sf), "text", fv.TEXT_CONTEXT, "doc", "page_no")
    whole = tx.newline_to_space(F.concat("before", "email", "after"))
    return dedup.last_per_email(rows, ["doc", "email"], ["page_no", "pos"], whole)


# Copies of a text get one id; two languages lack an id or share one.
KEYED = f"(SELECT doc, source, lang, CASE lang WHEN 'fr' THEN '' ELSE sha1(text) END AS id, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 7 ELSE 3 END AS lane FROM {t.TEXTS})"


def keyed(spark, sf):
    lang = F.col("lang")
    return t.texts(spark, sf).select("doc", "source", "lang", F.when(lang == "fr", "").otherwise(F.sha1("text")).alias("id"),
                                     F.when(lang == "en", 1).when(lang == "de", 7).otherwise(3).alias("lane"))


@query("a4_dedup_by_id", f"""SELECT id, doc, source FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lane DESC, source DESC, doc DESC) AS n FROM {KEYED})
 WHERE n = 1 OR id = ''""")
def _(spark, sf):
    return dedup.dedup_by_id(keyed(spark, sf), ["lane", "source", "doc"]).select("id", "doc", "source")


@query("a5_flatten_collisions", f"SELECT bucket, name, max(path) AS path FROM {ROUTED} WHERE bucket IS NOT NULL GROUP BY bucket, name")
def _(spark, sf):
    routed = routing.drop_unknown_extension(t.files(spark, sf))
    return routing.flatten_collisions(routed).select("bucket", "name", "path")


@query("a6_findings_per_file", f"SELECT source AS file, count(DISTINCT email) AS emails FROM {matches(t.TEXTS, 'source')} GROUP BY source")
def _(spark, sf):
    rows = t.texts(spark, sf).select("source", F.explode(em.rfc_emails(F.col("text"))).alias("email"))
    return dedup.findings_per_file(rows, "source")


@query("a7_run_report", f"""SELECT status, CAST(sum(length(image)) AS BIGINT) AS names, count(*) AS n, min(image) AS first, max(image) AS last FROM {t.REPLIES}
 WHERE status <> 'ignored' GROUP BY status""")
def _(spark, sf):
    parts = identity.identity_report(t.replies(spark, sf), "image", "reply")
    sizes = F.aggregate("files", F.lit(0).cast("bigint"), lambda a, f: a + F.length(f))
    return parts.groupBy("status").agg(F.sum(sizes).alias("names"), F.sum("n").alias("n"), F.min(F.array_min("files")).alias("first"), F.max(F.array_max("files")).alias("last"))


@query("a8_concat_ordered", f"SELECT doc, string_agg(text, '' ORDER BY page_no) AS text FROM {t.PAGES} GROUP BY doc")
def _(spark, sf):
    return ordered.concat_ordered(t.pages(spark, sf), "doc", "page_no", "text")


@query("a9_presence_any", f"SELECT source AS file, bool_or(lang = 'fr' AND length(line) > 900 OR regexp_matches(line, {X3})) AS present FROM {t.LINES} GROUP BY source")
def _(spark, sf):
    long_french = (F.col("lang") == "fr") & (F.length("line") > 900)
    return sniff.presence_any(t.lines(spark, sf), "source", long_french, em.has_email(F.col("line"), em.SIMPLE))


# --- joins, order, sets -----------------------------------------------------------------


def sources(spark, sf):
    """Registered sources: the submissions, by their integer id."""
    return sinks.register_sources(t.submissions(spark, sf), F.lit("2025-01-01T00:00:00"))


@query("j1_attach_source", f"""SELECT x.id, x.id_source, s.post_title, s.group_name FROM (SELECT sha1(text) AS id, {SOURCE_ID} AS id_source FROM {t.TEXTS}) x
 JOIN {t.SUBMISSIONS} s ON x.id_source = s.id WHERE s.id <> 0""")
def _(spark, sf):
    rows = t.texts(spark, sf).select(F.sha1("text").alias("id"), source_id().alias("id_source"))
    # Every source is registered twice, the second time later: one row per finding stays.
    once = sources(spark, sf)
    again = once.withColumn("post_title", F.concat("post_title", F.lit(" (old)"))).withColumn("indexed", F.lit("2024-12-31T00:00:00"))
    return joins.attach_source(rows, once.unionByName(again)).select("id", "id_source", "post_title", "group_name")


@query("j2_skip_seen", f"SELECT file, sha1 FROM {KEPT_COPIES} WHERE sha1 NOT IN (SELECT sha1(text) FROM documents WHERE lang = 'en')")
def _(spark, sf):
    docs = t.documents(spark, sf)
    seen = docs.where(F.col("lang") == "en").select(ids.content_sha1(F.col("text")).alias("sha1"))
    return dedup.skip_seen(dedup.dedup_files(docs, "doc_id", "text"), seen)


@query("j3_keep_qualified", f"SELECT doc, page_no FROM {t.PAGES} WHERE doc IN (SELECT doc FROM {GATED})")
def _(spark, sf):
    pages = t.pages(spark, sf)
    return joins.keep_qualified(pages.select("doc", "page_no"), sniff.page_gate(pages), "doc").select("doc", big("page_no"))


@query("j4_route_lookup", f"SELECT f.path, b.bucket FROM {t.FILES} f JOIN (VALUES {BUCKETS}) AS b(ext, bucket) ON f.ext = b.ext")
def _(spark, sf):
    return joins.route_lookup(t.files(spark, sf), "inner").select("path", "bucket")


@query("w1_running_chars", f"SELECT doc, seq, CAST(chars_before AS BIGINT) AS chars_before FROM {READ.format(blocks='(SELECT conv_id AS doc, turn AS seq, text FROM conversations)')}")
def _(spark, sf):
    c = t.table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("seq"), "text")
    return ordered.running_chars(c).select("doc", "seq", big("chars_before"))


@query("l1_head_n", "SELECT * FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 20")
def _(spark, sf):
    return ordered.head_n(t.documents(spark, sf).select("source", "doc_id"), "source", "doc_id", 20).withColumn("rank", big("rank"))


@query("u1_union_lanes", f"SELECT doc, email FROM {matches(t.TEXTS, 'doc')} UNION ALL SELECT doc, email FROM {matches(t.TEXTS, 'doc', pattern=X3)} UNION ALL SELECT doc, address FROM {TAGGED}")
def _(spark, sf):
    one, two = (found(spark, sf, f).select("doc", "email") for f in (em.rfc_emails, em.simple_emails))
    return index.union_lanes(one, two, tagged(spark, sf).select("doc", F.col("address").alias("email")))


@query("u2_union_dirs", f"SELECT path, size FROM {t.FILES} WHERE size >= 512 UNION ALL SELECT path, size FROM {t.FILES} WHERE NOT is_link")
def _(spark, sf):
    files = t.files(spark, sf)
    return index.union_dirs(routing.drop_small(files), routing.drop_links(files)).select("path", "size")


# --- lanes and jobs ---------------------------------------------------------------------


P1 = f"""SELECT file, email, email_context, sha1(email || '_' || email_context) AS id, CAST(file AS VARCHAR) AS origin FROM (
 SELECT doc AS file, email, {LINE_CONTEXT} AS email_context, row_number() OVER (PARTITION BY doc, email ORDER BY line_no) AS n FROM {LINE_HITS}
 WHERE doc IN (SELECT min(doc) FROM {t.TEXTS} GROUP BY sha1(text))) WHERE n = 1"""


@query("p1_text_lane", P1)
def _(spark, sf):
    return lanes.text_lane(fs.cut_pieces(t.texts(spark, sf), "doc", "text"))


@query("p1_text_lane_in_splits", P1)
def _(spark, sf):
    """Copies of a text are cut at different lines."""
    return lanes.text_lane(fs.cut_pieces(t.texts(spark, sf), "doc", "text", 1 + F.col("doc") % 5))


P2 = f"""SELECT doc AS file, email, email_context, sha1(email || email_context) AS id, 'Doc ' || doc AS origin FROM {LAST_HITS}
 WHERE NOT contains(name, 'Hiring') AND doc IN (SELECT doc FROM {GATED}) AND doc IN (
 SELECT doc FROM (SELECT doc, string_agg(text, '' ORDER BY page_no) AS text FROM {t.PAGES} GROUP BY doc) WHERE length({strip('text')}) > 50)"""


@query("p2_pdf_lane", P2)
def _(spark, sf):
    return lanes.pdf_lane(t.pages(spark, sf))


OFFICE_TEXT = f"(SELECT doc, ext, string_agg(text, chr(10) ORDER BY seq) AS text FROM {t.BLOCKS} WHERE ext <> 'doc' GROUP BY doc, ext)"
OFFICE_DIGITAL = f"(SELECT doc FROM (SELECT doc, string_agg(text, chr(10) ORDER BY seq) AS text FROM {READ.format(blocks=t.BLOCKS)} GROUP BY doc) WHERE length({strip('text')}) > 50)"
P3 = f"""SELECT file, email, email_context, sha1(email || email_context) AS id, origin FROM (
 SELECT doc AS file, email, {TEXT_CONTEXT} AS email_context, CASE ext WHEN 'pptx' THEN 'PPTX Archive' ELSE 'DOCX Archive' END AS origin,
 row_number() OVER (PARTITION BY doc, email ORDER BY pos DESC) AS n FROM {matches(OFFICE_TEXT, 'doc', 'ext')} WHERE doc IN {OFFICE_DIGITAL}) WHERE n = 1"""


@query("p3_office_lane", P3)
def _(spark, sf):
    return lanes.office_lane(t.blocks(spark, sf))


RECORDS = f"(SELECT doc, line_no, line AS note, {t.CONTACT} AS contact FROM {t.LINES})"
CSV_KEPT = f"(SELECT doc FROM {RECORDS} WHERE line_no <= 9 AND (contact <> '' OR regexp_matches(note, {X2})))"
NOTE, NUMBER = ("note, text", py_string("note")), ("line_no", "'\"' || line_no || '\"'")
CSV_CONTEXT = f"CASE WHEN contact <> '' THEN {py_dict(NUMBER, NOTE)} ELSE {py_dict(NUMBER, ('contact', chr(39) + chr(34) * 2 + chr(39)))} END"
P4 = f"""SELECT file, row_no, email, email_context, sha1(lower(email) || email_context) AS id, '' AS origin FROM (
 SELECT doc AS file, line_no AS row_no, CASE WHEN contact <> '' THEN contact ELSE regexp_extract(note, {X3}, 0) END AS email, {CSV_CONTEXT} AS email_context
 FROM {RECORDS} WHERE doc IN {CSV_KEPT} AND (contact <> '' OR regexp_matches(note, {X3})))"""


@query("p4_csv_lane", P4)
def _(spark, sf):
    return lanes.csv_lane(t.csv_texts(spark, sf), "doc", "text")


# A note of two lines, so that quotes are open where the splits, of one to three lines, meet. Ten lines are five records, almost.
P4_FOLDED = P4.replace(RECORDS, f"(SELECT * REPLACE (note || ' ' || note AS note) FROM {RECORDS})").replace("line_no <= 9", "line_no <= 5")


@query("p4_csv_lane_in_splits", P4_FOLDED)
def _(spark, sf):
    """Records of two lines, the second inside quotes, in splits that end anywhere."""
    folded = F.regexp_replace("text", r'(?md)^([0-9]+,[^,]*),"(.*)"$', '$1,"$2\n$2"')
    pieces = fs.cut_pieces(t.csv_texts(spark, sf).withColumn("text", folded), "doc", "text", 1 + F.col("doc") % 3)
    return lanes.csv_piece_lane(pieces).withColumn("file", big("file"))


SHEET_KEPT = f"(SELECT doc FROM {RECORDS} WHERE line_no <= 10 AND (contact <> '' OR regexp_matches(note, {X1})))"
SHEET_CONTEXT = f"CASE WHEN contact <> '' THEN {py_dict(('line_no', 'line_no'), ('note', py_string('note')))} ELSE {py_dict(('line_no', 'line_no'), ('contact', chr(39) + chr(34) * 2 + chr(39)))} END"
P5 = f"""SELECT file, row_no, email, email_context, sha1(lower(email) || email_context) AS id, '' AS origin FROM (
 SELECT doc AS file, line_no AS row_no, CASE WHEN contact <> '' THEN contact ELSE note END AS email, {SHEET_CONTEXT} AS email_context
 FROM {RECORDS} WHERE doc IN {SHEET_KEPT} AND (contact <> '' OR regexp_matches(note, {X1})))"""


def sheet_records(spark, sf):
    return records.sheet_records(t.sheet(spark, sf), F.col("doc"), F.col("line_no"), ["line_no", "contact", "note"])


@query("p5_sheet_lane", P5)
def _(spark, sf):
    return lanes.sheet_lane(sheet_records(spark, sf))


XML_LINES = t.lines_sql(f"(SELECT doc, xml AS text FROM {t.XML_DOCS})", "doc")
XML_KEPT = f"(SELECT doc FROM {XML_LINES} WHERE line_no <= 10 AND regexp_matches(line, {X1}) UNION SELECT doc FROM {t.XML_DOCS} WHERE contains(lower(xml), 'email'))"
P6 = f"""SELECT file, email, email_context, sha1(lower(email) || email_context) AS id, '' AS origin FROM (SELECT doc AS file, email, {XML_CONTEXT} AS email_context,
 row_number() OVER (PARTITION BY doc, email ORDER BY pos DESC) AS n FROM {matches(t.XML_DOCS, 'doc')} WHERE doc IN {XML_KEPT}) WHERE n = 1"""


@query("p6_xml_lane", P6)
def _(spark, sf):
    return lanes.xml_lane(t.xml_docs(spark, sf), "doc", "xml")


def index_sql(lane: str, rows: str, json_name: str, seq: str = "0", source: str = "7") -> str:
    origin = "origin || ' ' || " if lane in ("txt", "pdf", "docx", "pptx") else ""
    return f"""SELECT id, lower(email) AS email, email_context, {domain('email')} AS domain, {origin}{json_name} AS "from",
 {source} AS id_source, {fv.LANE_ORDER.index(lane) + 1} AS lane, CAST(file AS VARCHAR) AS file, CAST({seq} AS BIGINT) AS seq FROM ({rows})"""


# Files belong to ten sources; number 0 is none, and some are not registered.
FILE_SOURCE = "CAST(file % 10 AS INTEGER)"
INDEXED = " UNION ALL ".join([
    index_sql("txt", P1, "file || '.json'", source=FILE_SOURCE),
    index_sql("pdf", P2, "origin || '.json'", source=FILE_SOURCE),
    index_sql("docx", f"{P3} AND origin LIKE 'DOCX%'", "'d' || file || '.json'", source=FILE_SOURCE),
    index_sql("pptx", f"{P3} AND origin LIKE 'PPTX%'", "'d' || file || '.json'", source=FILE_SOURCE),
    index_sql("csv", P4, "'transformed_' || file || '.json'", "row_no", FILE_SOURCE),
    index_sql("xls", P5, "'transformed_' || file || '.json'", "row_no", FILE_SOURCE),
    index_sql("xml", P6, "file || '.json'", source=FILE_SOURCE),
])
P7 = f"""SELECT id, email, email_context, domain, "from", id_source FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lane DESC, file DESC, seq DESC) AS n
 FROM ({INDEXED}) WHERE id_source IN (SELECT id FROM {t.SUBMISSIONS} WHERE id <> 0)) WHERE n = 1"""


def all_lanes(spark, sf):
    """A lane at a time, so that what one holds on disk can go before the next one."""
    number = F.col("file") % 10
    file = F.col("file").cast("string")
    plain = F.concat(file, F.lit(".json"))
    office_lane = F.when(F.col("origin") == fv.PPTX_ORIGIN, "pptx").otherwise("docx")
    office_name = F.concat(F.lit("d"), file, F.lit(".json"))
    transformed = F.concat(F.lit("transformed_"), file, F.lit(".json"))
    yield index.index_rows(lanes.text_lane(fs.cut_pieces(t.texts(spark, sf), "doc", "text")), "txt", plain, number)
    yield index.index_rows(lanes.pdf_lane(t.pages(spark, sf)), "pdf", F.concat("origin", F.lit(".json")), number)
    yield index.index_rows(lanes.office_lane(t.blocks(spark, sf)), office_lane, office_name, number)
    yield index.index_rows(lanes.csv_lane(t.csv_texts(spark, sf), "doc", "text"), "csv", transformed, number, F.col("row_no"))
    yield index.index_rows(lanes.sheet_lane(sheet_records(spark, sf)), "xls", transformed, number, F.col("row_no"))
    yield index.index_rows(lanes.xml_lane(t.xml_docs(spark, sf), "doc", "xml"), "xml", plain, number)


@query("p7_index_all", P7)
def _(spark, sf):
    """All lanes, the findings of registered sources, upserted into an empty index."""
    root = f"{folder(spark)}/all"
    index.index_run(all_lanes(spark, sf), sources(spark, sf), root, sinks.RAW)
    return sinks.read_findings(spark, root)


@query("p8_identity_records", f"""SELECT country, authority, nullif(expires, '') AS expires, name, gender, nullif(born, '') AS born, address, number,
 image AS "from", 7255 AS id_source FROM {t.REPLIES} WHERE status = 'indexed'""")
def _(spark, sf):
    rows = identity.identity_records(t.replies(spark, sf), "image", "reply", F.lit(7255))
    return short(rows, F.col("FROM").alias("from"), "id_source")


@query("p8_identity_report", f"SELECT status, image AS file FROM {t.REPLIES} WHERE status <> 'ignored'")
def _(spark, sf):
    return identity.identity_report(t.replies(spark, sf), "image", "reply").select("status", F.explode("files").alias("file"))


STAYING = f"(SELECT * FROM {ROUTED} WHERE NOT is_link AND size >= 512 AND bucket IS NOT NULL)"


@query("p9_organise", f"SELECT bucket, name, max(path) AS path, arg_max(size, path) AS size FROM {STAYING} GROUP BY bucket, name")
def _(spark, sf):
    return organise.organise(t.files(spark, sf)).select("bucket", "name", "path", "size")


@query("p9_file_verdicts", f"""SELECT path, bucket, CASE WHEN is_link THEN 'link' WHEN size < 512 THEN 'small' WHEN bucket IS NULL THEN 'unknown_extension' ELSE 'kept' END AS verdict FROM {ROUTED}""")
def _(spark, sf):
    return organise.file_verdicts(t.files(spark, sf)).select("path", "bucket", "verdict")


def write_by_doc(rows, root):
    """What ``rows.write.partitionBy("doc").text(root)`` puts in the folders below, checksums included, into a folder all executors see.

    Hadoop starts two processes for each local file, to set its permissions, and moves each twice.
    """
    name = f"-{uuid.uuid4()}.c000.txt"

    def write(batches):
        import os
        import struct
        import zlib
        from itertools import groupby

        import pyarrow as pa
        from pyspark import TaskContext

        part = f"part-{TaskContext.get().partitionId():05d}{name}"
        lines = ((d, v) for b in batches for d, v in zip(b.column("doc").to_pylist(), b.column("value").to_pylist()))
        for doc, some in groupby(lines, lambda x: x[0]):
            folder = f"{root}/doc={'__HIVE_DEFAULT_PARTITION__' if doc is None else doc}"
            data = b"".join((v or b"") + b"\n" for _, v in some)
            sums = (struct.pack(">I", zlib.crc32(data[k:k + 512])) for k in range(0, len(data), 512))
            os.makedirs(folder, exist_ok=True)
            for file, value in ((part, data), (f".{part}.crc", b"crc\0" + struct.pack(">i", 512) + b"".join(sums))):
                with open(f"{folder}/{file}", "wb") as out:  # the same name if the task runs again
                    out.write(value)
        yield pa.RecordBatch.from_arrays([pa.array([part])], names=["part"])

    os.makedirs(root)
    rows.select("doc", F.col("value").cast("binary").alias("value")).sortWithinPartitions("doc").mapInArrow(write, "part string").count()


def folder_of_documents(spark, sf):
    """A text file per document; the English ones have a line of addresses."""
    text = F.when(F.col("lang") == "en", F.col("text")).otherwise(F.substring_index("text", '\n"Q ', 1))
    path = f"{folder(spark)}/dump"
    tasks = 4 * spark.sparkContext.defaultParallelism
    rows = t.texts(spark, sf).select(F.col("doc"), text.alias("value")).repartition(tasks, "doc")
    if urlparse(path).scheme in ("", "file"):
        write_by_doc(rows, urlparse(path).path)
    else:
        rows.write.partitionBy("doc").text(path)
    return path


# Tasks give files of several documents one name, so names are not flattened here.
DUMP = """(SELECT doc, lang, CASE WHEN lang = 'en' THEN text ELSE regexp_replace(text, '(?s)\n"Q .*', '') END AS text FROM """ + t.TEXTS + ")"
DUMP_HITS = f"(SELECT DISTINCT doc, email FROM {matches(t.lines_sql(DUMP, 'doc'), 'doc', text='line')} WHERE regexp_matches(email, {STRICT}))"
LEDGER = f"""SELECT doc, CASE WHEN size < 512 THEN 'small' WHEN n > 1 THEN 'copy' WHEN findings > 0 THEN 'found' ELSE 'nothing_found' END AS verdict,
 CASE WHEN size < 512 OR n > 1 THEN 0 ELSE coalesce(findings, 0) END AS findings FROM (
 SELECT doc, size, row_number() OVER (PARTITION BY size < 512, text ORDER BY 'doc=' || doc || '/') AS n
 FROM (SELECT doc, text, octet_length(encode(text)) + 1 AS size FROM {DUMP})) LEFT JOIN (SELECT doc, count(*) AS findings FROM {DUMP_HITS} GROUP BY doc) USING (doc)"""


@query("p10_run_folder", LEDGER)
def _(spark, sf):
    """Listing, routing, lanes, index and ledger of a folder of files."""
    path, registered = folder_of_documents(spark, sf), sources(spark, sf)
    ledger = run_folder(spark, path, registered, 7, f"{folder(spark)}/index", sinks.RAW, flatten=False)
    ledger = ledger.where(ids.file_ext(F.col("path")) == "txt")
    return ledger.select(F.regexp_extract("path", "doc=([0-9]+)/", 1).cast("bigint").alias("doc"), "verdict", "findings")


@query("s11_list_files")
def _(spark, sf):
    """The files of the given tables themselves."""
    return list_all_files(spark, sf)


# --- sinks ------------------------------------------------------------------------------


def folder(spark: SparkSession) -> str:
    """A new folder: below the cluster's shared one where it is named, else a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        return tempfile.mkdtemp(prefix="exposcan-out-")
    return f"{shared}/out-{spark.sparkContext.applicationId}-{spark._jvm.java.util.UUID.randomUUID()}"


def findings(spark, sf):
    rows = lanes.text_lane(fs.cut_pieces(t.texts(spark, sf), "doc", "text"))
    return index.index_rows(rows, "txt", F.concat(F.col("file").cast("string"), F.lit(".json")), F.lit(7))


FINDINGS = index_sql("txt", P1, "file || '.json'")
PROTECT = sinks.Protection(key="check")
MASKED = f"regexp_replace(regexp_replace(email_context, {X3}, '[email]', 'g'), {X1}, '[email]', 'g')"


def hmac_sql(value: str) -> str:
    """Keyed hash by its definition: the key, padded to a block, is mixed with two constants."""
    key = b"check".ljust(64, b"\0")
    inner, outer = (f"unhex('{bytes(k ^ mix for k in key).hex()}')" for mix in (0x36, 0x5C))
    return f"CASE WHEN {value} <> '' THEN sha256({outer} || unhex(sha256({inner} || encode({value})))) ELSE {value} END"


@query("k1_write_findings", f"""SELECT {hmac_sql('id')} AS id, {hmac_sql('email')} AS email, {MASKED} AS email_context, domain, "from", id_source FROM ({FINDINGS})""")
def _(spark, sf):
    path = f"{folder(spark)}/findings"
    sinks.write_findings(findings(spark, sf).select(*fv.FINDING_FIELDS), path, PROTECT)
    return spark.read.parquet(path).select(*fv.FINDING_FIELDS)


# The second batch repeats the whole first one, some ids with a new context.
@query("k2_upsert_findings", f"""SELECT id, email, CASE WHEN email LIKE '%2@%' THEN 'new' ELSE email_context END AS email_context, domain, "from", id_source FROM (
 SELECT *, row_number() OVER (PARTITION BY id ORDER BY file DESC) AS n FROM ({FINDINGS})) WHERE n = 1""")
def _(spark, sf):
    root = f"{folder(spark)}/index"
    rows = findings(spark, sf)
    sinks.upsert_findings(rows, root, sinks.RAW, index.ORDER)
    changed = F.when(F.col("email").like("%2@%"), "new").otherwise(F.col("email_context"))
    second = rows.withColumn("email_context", changed)
    sinks.upsert_findings(second, root, sinks.RAW, index.ORDER)
    return sinks.read_findings(spark, root)


@query("k3_append_records", f"""SELECT {hmac_sql('number')} AS number, {hmac_sql('name')} AS name, {hmac_sql("nullif(born, '')")} AS born, image AS "from"
 FROM {t.REPLIES}, (VALUES (1), (2)) WHERE status = 'indexed'""")
def _(spark, sf):
    """Two batches, each appended twice: it counts once."""
    path = f"{folder(spark)}/records"
    rows = identity.identity_records(t.replies(spark, sf), "image", "reply", F.lit(7255))
    for batch in ("monday", "tuesday", "monday", "tuesday"):
        sinks.append_records(rows, path, PROTECT, batch)
    read = sinks.read_records(spark, path)
    return read.select(F.col("ID_Number").alias("number"), F.col("Name").alias("name"), F.col("Date_of_Birth").alias("born"), F.col("FROM").alias("from"))


@query("k4_register_sources", f"SELECT post_title, group_name, discovered, description, website, indexed, post_url, country, CAST(id AS INTEGER) AS id FROM {t.SUBMISSIONS}")
def _(spark, sf):
    return sources(spark, sf)
