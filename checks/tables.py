"""Inputs that Spark derives from the given tables, and the same inputs in SQL.

Few of the given texts hold addresses, so every text gets a last line with some, built from
the text's length: equal texts stay equal. All tables are used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exposcan.functions.text import let, lines_of, replace_any
from exposcan.session import spread, with_once
from exposcan.sources.markup import page_text

EXTENSIONS = ["txt", "PDF", "", "exe", "docx", "Csv", "json", "jpg", "xlsx", "xml", "tar", "md"]
SUFFIXES = [".json", ".JSON", ".csv", ".CSV", ".xls", ".XLSX", ".xml", ".pdf", ".Doc", ".docx", ".ppt", ".pptx", ".txt", ""]
TITLES = ["Hiring_CV", "resume", "hiring passport", "Annual Hiring", "HIRING-Resume", "cv"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, lang, source, text``: documents with a line of addresses."""
    n = F.length("text").cast("string")
    tail = F.concat(
        F.lit('\n"Q '), n, F.lit('"@quoted.example.org|o\'neil'), n, F.lit("@mail.example.com, Ab+"), n,
        F.lit("@Host"), (F.length("text") % 7).cast("string"), F.lit(".Example.co.uk; x@y.example"),
    )
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("doc"), "lang", "source", F.concat("text", tail).alias("text")
    )


TEXTS = """(SELECT doc_id AS doc, lang, source, text || chr(10) || '"Q ' || length(text)
 || '"@quoted.example.org|o''neil' || length(text) || '@mail.example.com, Ab+' || length(text)
 || '@Host' || (length(text) % 7) || '.Example.co.uk; x@y.example' AS text FROM documents)"""


def cycle(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int") + 1)


def cycle_sql(values: list[str], key: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[({key} % {len(values)}) + 1]"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, name, ext, size, is_link``, one per document; sources share base names."""
    ext = cycle(EXTENSIONS, F.col("doc_id"))
    suffix = F.when(ext == "", F.lit("")).otherwise(F.concat(F.lit("."), ext))
    name = F.concat(F.lit("f"), (F.length("text") % 50).cast("string"), suffix)
    return documents(spark, sf_dir).select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("/"), name).alias("path"),
        name.alias("name"),
        F.lower(ext).alias("ext"),
        F.octet_length("text").cast("bigint").alias("size"),
        (F.col("lang") == "es").alias("is_link"),
    )


FILES = f"""(SELECT source || '/' || doc_id || '/' || name AS path, name, lower(e) AS ext,
 CAST(octet_length(encode(text)) AS BIGINT) AS size, lang = 'es' AS is_link FROM (
 SELECT *, 'f' || (length(text) % 50) || CASE WHEN e = '' THEN '' ELSE '.' || e END AS name
 FROM (SELECT *, {cycle_sql(EXTENSIONS, "doc_id")} AS e FROM documents)))"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, lang, source, line_no, line``."""
    return texts(spark, sf_dir).select(
        "doc", "lang", "source", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")
    ).select("doc", "lang", "source", (F.col("pos") + 1).alias("line_no"), "line")


def lines_sql(source: str, *keep: str, text: str = "text") -> str:
    """Lines as a text-mode reader yields them."""
    normal = f"regexp_replace({text}, '\\r\\n?', chr(10), 'g')"
    body = f"regexp_replace({normal}, '\\n\\z', '')"
    split = f"CASE WHEN {text} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({body}, chr(10)) END"
    names = "".join(f"{k}, " for k in keep)
    return (
        f"(SELECT {names}CAST(i AS BIGINT) AS line_no, ls[i] AS line FROM (SELECT {names}ls, unnest(range(1, len(ls) + 1)) AS i "
        f"FROM (SELECT {names}{split} AS ls FROM {source})))"
    )


LINES = lines_sql(TEXTS, "doc", "lang", "source")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, name, page_no, text``: a line is a page; Spanish documents are application papers."""
    split = page_text(texts(spark, sf_dir).withColumn("key", F.struct("doc", "lang")), "key", "text")
    name = F.concat(F.when(F.col("doc.lang") == "es", "Hiring CV ").otherwise("Doc "), F.col("doc.doc").cast("string"), F.lit(".pdf"))
    return split.select(F.col("doc.doc").alias("doc"), name.alias("name"), "page_no", "text")


PAGES = """(SELECT doc, CASE WHEN lang = 'es' THEN 'Hiring CV ' ELSE 'Doc ' END || doc || '.pdf' AS name,
 CAST(i AS BIGINT) AS page_no, ps[i] AS text FROM (SELECT doc, lang, ps, unnest(range(1, len(ps) + 1)) AS i
 FROM (SELECT doc, lang, string_split(text, chr(10)) AS ps FROM """ + TEXTS + ")))"


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, name, ext, seq, text``: a line is a block; the language gives the format."""
    ext = F.when(F.col("lang") == "fr", "pptx").when(F.col("lang") == "es", "doc").otherwise("docx")
    return lines(spark, sf_dir).select(
        "doc", F.concat(F.lit("d"), F.col("doc").cast("string")).alias("name"), ext.alias("ext"),
        F.col("line_no").alias("seq"), F.col("line").alias("text"),
    )


BLOCKS = f"""(SELECT doc, CASE lang WHEN 'fr' THEN 'pptx' WHEN 'es' THEN 'doc' ELSE 'docx' END AS ext,
 line_no AS seq, line AS text FROM {LINES})"""


def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, text``: a csv text per document, a record per line, every other line with a contact."""
    def record(line: Column, i: Column) -> Column:
        contact = F.when(F.length(line) % 2 == 0, F.concat(F.lit("c"), (i + 1).cast("string"), F.lit("@"), F.col("source"), F.lit(".example.org"))).otherwise("")
        note = F.concat(F.lit('"'), replace_any(line, '"', '""'), F.lit('"'))
        return F.concat((i + 1).cast("string"), F.lit(","), contact, F.lit(","), note)

    body = F.array_join(F.transform(lines_of(F.col("text")), record), "\n")
    csv = F.concat(F.lit('line_no,contact,"note, text"\n'), body)
    return with_once(texts(spark, sf_dir), csv=csv).select("doc", F.col("csv").alias("text"))


CONTACT = "CASE WHEN length(line) % 2 = 0 THEN 'c' || line_no || '@' || source || '.example.org' ELSE '' END"


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, line_no, contact, note``: the same records as a typed table."""
    contact = F.when(F.length("line") % 2 == 0, F.concat(F.lit("c"), F.col("line_no").cast("string"), F.lit("@"), F.col("source"), F.lit(".example.org")))
    return lines(spark, sf_dir).select("doc", "line_no", contact.alias("contact"), F.col("line").alias("note"))


# Most texts hold these characters only, listed one by one as in ``emails._class``.
_LEGAL = r"\A[" + "".join(f"\\x{code:02x}" for code in (0x09, 0x0A, 0x0D, *range(0x20, 0x100))) + r"]*+\z"


def _escape(text: Column) -> Column:
    written = F.when(text.rlike(_LEGAL), text).otherwise(F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]", ""))
    return let(written, lambda w: let(replace_any(w, "&", "&amp;"), lambda a: let(
        replace_any(a, "<", "&lt;"), lambda b: replace_any(b, ">", "&gt;"))))


def xml_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, xml``: the text in markup, with an attribute, a comment and a second node."""
    xml = F.concat(
        F.lit('<?xml version="1.0"?>\n<d a="1>0"><!-- note --><p>'), _escape(F.col("text")),
        F.lit("</p><s>"), F.col("source"), F.lit("</s></d>"),
    )
    return with_once(texts(spark, sf_dir), xml=xml).select("doc", "xml")


LEGAL = r"regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]', '', 'g')"
XML_DOCS = f"""(SELECT doc, '<?xml version="1.0"?>' || chr(10) || '<d a="1>0"><!-- note --><p>' ||
 replace(replace(replace({LEGAL}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><s>' || source || '</s></d>' AS xml,
 translate(regexp_replace({LEGAL}, '\\r\\n?', chr(10), 'g') || ' ' || source, chr(10), ' ') AS text
 FROM {TEXTS})"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``image, reply``: a model reply per customer; segments and nations make the odd cases."""
    c = spread(table(spark, sf_dir, "customer"))
    key = F.col("c_custkey").cast("string")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    info = F.to_json(F.struct(
        F.concat(F.lit("N"), nation.cast("string")).alias("Country"),
        F.lit("").alias("Expiration Date"),
        F.when(segment == "BUILDING", "").otherwise(F.col("c_name")).alias("Name"),
        F.when(nation % 2 == 0, "M").otherwise("").alias("Gender"),
        F.when(nation < 5, "").otherwise("1990-01-01").alias("Date of Birth"),
        segment.alias("Address"),
        F.when(segment == "BUILDING", "").otherwise(F.concat(F.lit("ID-"), key)).alias("ID Number"),
    ))
    block = F.concat(F.lit('{"Information": '), info, F.lit("}"))
    reply = (
        F.when(segment == "FURNITURE", F.concat(F.lit("no document in "), key))
        .when((segment == "MACHINERY") & (nation < 8), F.concat(F.lit('{"Other": '), key, F.lit("}")))
        .when((segment == "MACHINERY") & (nation < 12), F.concat(block, F.lit(" and {")))
        .when((segment == "MACHINERY") & (nation < 16), F.concat(block, F.lit(" and {}")))
        .otherwise(F.concat(F.lit("Sure:\n```json\n"), block, F.lit("\n```")))
    )
    return c.select(F.concat(F.lit("scan"), key, F.lit(".png")).alias("image"), reply.alias("reply"))


# status of each reply and its fields
REPLIES = """(SELECT 'scan' || c_custkey || '.png' AS image,
 CASE WHEN c_mktsegment = 'FURNITURE' THEN 'error'
  WHEN c_mktsegment = 'MACHINERY' AND c_nationkey < 8 THEN 'ignored'
  WHEN c_mktsegment = 'MACHINERY' AND c_nationkey >= 12 AND c_nationkey < 16 THEN 'error'
  WHEN c_mktsegment = 'BUILDING' THEN 'skipped' ELSE 'indexed' END AS status,
 'N' || c_nationkey AS country, '' AS authority, '' AS expires,
 CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS name,
 CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE '' END AS gender,
 CASE WHEN c_nationkey < 5 THEN '' ELSE '1990-01-01' END AS born, c_mktsegment AS address,
 CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'ID-' || c_custkey END AS number FROM customer)"""


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leak-source submissions, one per supplier, as people type them."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    odd = F.col("s_nationkey") % 2 == 1
    blank = F.lit(" \t ")
    return s.select(
        F.concat(F.lit("  "), F.col("s_name"), F.lit("\n")).alias("post_title"),
        F.concat(F.lit("group "), F.col("s_nationkey").cast("string")).alias("group_name"),
        F.when(odd, blank).otherwise(F.lit("2024-05-06T07:08:09")).alias("discovered"),
        blank.alias("description"),
        F.concat(F.lit("https://s"), key, F.lit(".example ")).alias("website"),
        F.concat(F.lit("https://p.example/"), key).alias("post_url"),
        F.lit("").alias("country"),
        F.when(F.col("s_nationkey") == 3, F.concat(key, F.lit("x"))).otherwise(F.concat(F.lit(" "), key)).alias("id"),
    )


SUBMISSIONS = """(SELECT s_name AS post_title, 'group ' || s_nationkey AS group_name,
 CASE WHEN s_nationkey % 2 = 1 THEN '2025-01-01T00:00:00' ELSE '2024-05-06T07:08:09' END AS discovered,
 '' AS description, 'https://s' || s_suppkey || '.example' AS website, '2025-01-01T00:00:00' AS indexed,
 'https://p.example/' || s_suppkey AS post_url, '' AS country,
 CASE WHEN s_nationkey = 3 THEN 0 ELSE s_suppkey END AS id FROM supplier)"""
