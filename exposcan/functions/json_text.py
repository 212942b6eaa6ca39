"""JSON text: validity, Python-style rendering and the JSON block of a model reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan.functions.text import let, python_float, replace_any

_STRICT = {"allowSingleQuotes": "false"}
_ASCII = {"writeNonAsciiCharacterAsCodePoint": "true"}
_ESCAPES = r"\\u[0-9A-F]{4}|\\.|[^\\]++"
# Printable ASCII without quote and backslash, listed one by one as in ``emails._class``.
_PLAIN = r"\A[" + "".join(f"\\x{code:02x}" for code in range(0x20, 0x7F) if chr(code) not in '"\\') + r"]*+\z"
_TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[,:]|[^",:]++'


def one_json_value(text: Column) -> Column:
    """The JSON value as compact text, null when the text is not exactly one JSON value."""
    return let(_wrapped(text), lambda w: F.when(w["whole"], w["values"][0]))


def valid_json(text: Column) -> Column:
    return F.coalesce(let(_wrapped(text), lambda w: w["whole"]), F.lit(False))


def _wrapped(text: Column) -> Column:
    """The text read as an array's first element, before a mark.

    The mark is a hash of the text, so no text holds its own. Only a text that is one value and nothing
    else leaves two elements, the second being the mark.
    """
    mark = F.sha1(text)
    values = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>", _STRICT)
    return let(
        F.struct(values.alias("values"), mark.alias("mark")),
        lambda w: F.struct(w["values"].alias("values"), ((F.size(w["values"]) == 2) & (F.get(w["values"], F.lit(1)) == w["mark"])).alias("whole")),
    )


def last_entries(members: Column) -> Column:
    """The entries of a map read from JSON, the last one of each key as Python keeps it."""

    def latest(entries: Column) -> Column:
        places = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"))))
        kept = let(places, lambda p: F.filter(p, lambda e, i: ~F.coalesce(F.get(p, i + 1)["key"] == e["key"], F.lit(False))))
        repeated = F.size(F.array_distinct(F.transform(entries, lambda e: e["key"]))) < F.size(entries)
        return F.when(repeated, F.transform(kept, lambda k: F.get(entries, k["at"]))).otherwise(entries)

    return let(F.map_entries(members), latest)


def last_members(text: Column, names: list[str]) -> Column:
    """Struct of these members of a JSON object as text: of repeated keys the last, null where missing."""
    return F.from_json(text, ", ".join(f"`{name}` string" for name in names))


def falsy_members(text: Column, names: list[str]) -> Column:
    """Struct of flags: whether Python takes the member of a JSON object for false: missing, null, false, 0 or empty.

    The text is parsed once per kind a member can have, for all names at a time.
    """
    read = {kind: F.from_json(text, ", ".join(f"`{name}` {kind}" for name in names)) for kind in ("string", "double", "boolean", "array<string>", "map<string,string>")}
    parsed = F.struct(*[column.alias(f"k{n}") for n, column in enumerate(read.values())])

    def flag(kinds: Column, name: str) -> Column:
        string, double, boolean, *lists = (kinds[f"k{n}"][name] for n in range(len(read)))
        empty = [F.coalesce(F.size(x) == 0, F.lit(False)) for x in lists]
        return F.coalesce(string == "", F.lit(True)) | F.coalesce(double == 0, F.lit(False)) | ~F.coalesce(boolean, F.lit(True)) | empty[0] | empty[1]

    return let(parsed, lambda kinds: F.struct(*[flag(kinds, name).alias(name) for name in names]))


def _lower_escapes(quoted: Column) -> Column:
    """Write ``\\uXXXX`` in lower case, leaving other escapes and plain text alone."""
    tokens = F.regexp_extract_all(quoted, F.lit(_ESCAPES), F.lit(0))
    lowered = F.array_join(
        F.transform(tokens, lambda t: F.when(t.startswith("\\u"), F.lower(t)).otherwise(t)), ""
    )
    # Without an escaped backslash, every backslash before a "u" starts such an escape.
    code = lambda p: F.concat(F.lit("\\u"), F.lower(F.left(p, F.lit(4))), F.substring(p, F.lit(5), F.length(p)))
    parts = F.array_join(F.transform(F.split(quoted, r"\\u", -1), lambda p, i: F.when(i == 0, p).otherwise(code(p))), "")
    return F.when(~quoted.contains("\\u"), quoted).when(quoted.contains("\\\\"), lowered).otherwise(parts)


def json_quote(text: Column) -> Column:
    """A JSON string as Python's ``json.dumps`` writes it: ASCII only, lower-case escapes."""

    def python_style(quoted: Column) -> Column:
        return let(_lower_escapes(quoted), lambda lowered: replace_any(lowered, "\x7f", "\\u007f"))

    unlisted = lambda listed: F.substring(listed, F.lit(2), F.length(listed) - 2)
    return F.when(text.rlike(_PLAIN), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        let(let(F.to_json(F.array(text), _ASCII), unlisted), python_style))


def python_json_text(compact: Column) -> Column:
    """Compact JSON text re-spaced and escaped as ``json.dumps`` writes it."""
    tokens = F.regexp_extract_all(compact, F.lit(_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, _python_token), "")


def _python_token(token: Column) -> Column:
    separator = F.concat(token, F.lit(" "))
    string = json_quote(F.get_json_object(F.concat(F.lit("["), token, F.lit("]")), "$[0]"))
    return (
        F.when((token == ",") | (token == ":"), separator)
        .when(token.startswith('"') & token.rlike(r"[^ -~]|\\"), string)
        .when(~token.startswith('"') & token.contains("E"), _numbers(token))
        .otherwise(token)
    )


def _numbers(token: Column) -> Column:
    """Numbers with an exponent inside a run of brackets, numbers and words."""
    parts = F.regexp_extract_all(token, F.lit(r"-?[0-9][0-9.]*E[0-9-]+|-?[0-9][0-9.]*+(?!E)|[^0-9-]++|-"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.contains("E") & p.rlike("^-?[0-9]"), python_float(p.try_cast("double"))).otherwise(p)), "")


def python_str(compact: Column) -> Column:
    """Compact JSON text of a list, boolean or null as Python's ``str`` writes the value."""
    tokens = F.regexp_extract_all(compact, F.lit(_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, _python_repr), "")


def _python_repr(token: Column) -> Column:
    value = F.get_json_object(F.concat(F.lit("["), token, F.lit("]")), "$[0]")
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        value = F.replace(value, F.lit(plain), F.lit(written))
    single = value.contains("'") & ~value.contains('"')
    string = F.when(single, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )
    words = token
    for json_word, python_word in (("true", "True"), ("false", "False"), ("null", "None")):
        words = F.replace(words, F.lit(json_word), F.lit(python_word))
    return (
        F.when((token == ",") | (token == ":"), F.concat(token, F.lit(" ")))
        .when(token.startswith('"'), string)
        .when(token.contains("E"), _numbers(words))
        .otherwise(words)
    )


def python_json(fields: Column) -> Column:
    """A record's fields as ``json.dumps`` writes the dict; see ``sources.records`` for fields."""

    def member(f: Column) -> Column:
        value = F.when(f["raw"] | f["value"].isNull(), f["value"]).otherwise(json_quote(f["value"]))
        key = F.when(f["name"].isNull(), F.lit('"null"')).otherwise(json_quote(f["name"]))
        return F.concat(key, F.lit(": "), F.coalesce(value, F.lit("null")))

    return F.concat(F.lit("{"), F.array_join(F.transform(fields, member), ", "), F.lit("}"))


def json_block(reply: Column) -> Column:
    """From the first ``{`` to the last ``}``; null when there is no such block."""
    start = F.instr(reply, F.lit("{"))
    end = F.length(reply) - F.instr(F.reverse(reply), F.lit("}")) + 1
    return F.when((start > 0) & (end > start) & reply.contains("}"), F.substring(reply, start, end - start + 1))
