"""Text of XML documents.

The engine's own XPath takes the text nodes. It fails the job on a document that does not parse, so every document is judged first by the
engine's XML reader, which marks such a document in its own row. Both see the document inside an element of their own, whose name no
document can know: so several roots, or text beside the root, are no parse errors but something the path can ask for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan.functions.text import let, newline_to_space, replace_any

# Only space, instructions and comments may stand before it.
_DOCTYPE = r"(?s)\A(\x{FEFF}?(?:\s++|<\?.*?\?>|<!--.*?-->)*+)(<!DOCTYPE[^\[>]*+(?:\[.*?\]\s*+)?+>)"
_PROLOG = r"\A\x{FEFF}?<\?xml\s[^>]*+>"
_LITERAL = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_ENTITY = r"""<!ENTITY\s+([A-Za-z_:][\w:.-]*)\s+(?:"([^"<&%]*)"|'([^'<&%]*)')\s*>"""
#: Most characters entities may add to a document; one that would grow more counts as not parsing.
MOST_ADDED = 10_000_000


def with_entities(xml: Column) -> Column:
    """The document with its own plain entities written out, without its DOCTYPE; null if they would add too much.

    Entities made of other entities or of markup stay; a document using one does not parse.
    """
    doctype = F.regexp_extract(xml, _DOCTYPE, 2)
    column = lambda n: F.regexp_extract_all(doctype, F.lit(_ENTITY), F.lit(n))
    entities = F.arrays_zip(column(1).alias("name"), F.zip_with(column(2), column(3), lambda a, b: F.concat(a, b)).alias("value"))
    body = F.regexp_replace(xml, _DOCTYPE, "$1")

    def added(text: Column, e: Column) -> Column:
        reference = F.concat(F.lit("&"), e["name"], F.lit(";"))
        count = (F.length(text) - F.length(F.replace(text, reference, F.lit("")))) / F.length(reference)
        return F.when(count * F.length(e["value"]) <= MOST_ADDED, F.replace(text, reference, e["value"]))

    written = let(entities, lambda es: F.aggregate(es, body, added))
    return F.when(xml.contains("<!ENTITY"), written).when(xml.contains("<!DOCTYPE"), body).otherwise(xml)


def _escaped(text: Column) -> Column:
    for mark, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(reference))
    return text


def without_literals(xml: Column) -> Column:
    """Literal sections written as escaped text: the path would take only the first of neighbouring ones."""
    parts = F.zip_with(
        F.split(xml, _LITERAL, -1), F.regexp_extract_all(xml, F.lit(_LITERAL), F.lit(0)),
        lambda text, token: F.concat(text, F.coalesce(
            F.when(token.startswith("<!["), _escaped(F.substring(token, F.lit(10), F.length(token) - 12))).otherwise(token), F.lit(""))),
    )
    return F.when(xml.contains("<![CDATA["), F.array_join(parts, "")).otherwise(xml)


def _without_prolog(xml: Column) -> Column:
    """The declaration ends at the first ``>``, so the pattern needs to see the text up to there only."""
    head = F.concat(F.substring_index(xml, ">", 1), F.lit(">"))
    return let(head, lambda h: F.when(h.rlike(_PROLOG) & xml.contains(">"), F.substring(xml, F.length(h) + 1, F.length(xml))).otherwise(xml))


def _wrapped(xml: Column) -> Column:
    """The document inside an element named by its hash, without declaration, DOCTYPE and literal sections."""
    body = let(without_literals(with_entities(xml)), _without_prolog)
    name = F.concat(F.lit("_"), F.sha1(xml))
    return F.concat(F.lit("<"), name, F.lit(' one="1">'), body, F.lit("</"), name, F.lit(">"))


# The mark, then the text nodes, if the document is one element with nothing but space around it.
_ONE = "/*[count(*) = 1][not(text()[normalize-space()])]"
_PATH = f"{_ONE}/@one | {_ONE}/*//text()"


def _text_nodes(xml: Column) -> Column:
    """A mark and the text nodes in document order; null or empty if the document does not parse.

    Comments and instructions separate nodes.
    """

    def nodes(wrapped: Column) -> Column:
        parsed = F.from_xml(wrapped, "_corrupt_record string, _none string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        return F.when(parsed["_corrupt_record"].isNull(), F.xpath(wrapped, F.lit(_PATH)))

    return let(_wrapped(xml), lambda wrapped: F.when(wrapped.isNotNull(), nodes(wrapped)))


def well_formed_xml(xml: Column) -> Column:
    """Whether the document parses; anything but space beside its root also fails it. Prefixes of names need not be declared."""
    return F.coalesce(F.size(_text_nodes(xml)) > 0, F.lit(False))


def xml_text(xml: Column) -> Column:
    """All text nodes joined by one space, line ends turned into spaces; null if malformed."""

    def text_of(nodes: Column) -> Column:
        texts = F.slice(nodes, F.lit(2), F.size(nodes))
        spaced = let(F.array_join(texts, " "), lambda joined: let(newline_to_space(joined), lambda t: replace_any(t, "\r", " ")))
        return F.when(F.size(nodes) > 0, spaced)

    return let(_text_nodes(xml), text_of)
