"""SQL building blocks for the expected results."""

from __future__ import annotations

from exposcan import fixed_values as fv


def literal(text: str) -> str:
    """A SQL string literal; characters beyond plain ASCII are spelled with chr()."""
    parts, plain = [], ""
    for c in text:
        if " " <= c <= "~":
            plain += c
        else:
            parts += [plain, ord(c)]
            plain = ""
    parts.append(plain)
    spelled = ["chr(%d)" % p if isinstance(p, int) else "'" + p.replace("'", "''") + "'" for p in parts if p != ""]
    return "(" + " || ".join(spelled or ["''"]) + ")"


X1, X2, X3 = (f"'{p}'" for p in (fv.RFC_EMAIL, fv.RFC_EMAIL_RELAXED, fv.SIMPLE_EMAIL))
STRICT = "'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}\\z'"
WHITESPACE = literal(fv.WHITESPACE)


def strip(expr: str) -> str:
    return f"trim({expr}, {WHITESPACE})"


def domain(email: str) -> str:
    return f"lower(CASE WHEN contains({email}, '@') THEN split_part({email}, '@', 2) ELSE '' END)"


def window(text: str, start: str, size: str, radius: int) -> str:
    """``radius`` characters each side of the match at 0-based ``start``."""
    first = f"greatest({start} - {radius}, 0)"
    return f"substr({text}, {first} + 1, {start} + {size} + {radius} - {first})"


def matches(source: str, *keep: str, pattern: str = X1, text: str = "text") -> str:
    """``keep, text, pos, email, start`` of every match, offsets from 0."""
    names = "".join(f"{k}, " for k in keep)
    return f"""(SELECT {names}{text}, CAST(i AS BIGINT) AS pos, ms[i] AS email,
 CAST(coalesce(list_sum(list_transform(ss[1:i], lambda s: length(s))), 0)
 + coalesce(list_sum(list_transform(ms[1:i-1], lambda s: length(s))), 0) AS BIGINT) AS start
 FROM (SELECT {names}{text}, ms, ss, unnest(range(1, len(ms) + 1)) AS i FROM (
 SELECT {names}{text}, regexp_extract_all({text}, {pattern}, 0) AS ms, string_split_regex({text}, {pattern}) AS ss
 FROM {source} WHERE contains({text}, '@'))))"""


def py_string(expr: str) -> str:
    """A JSON string as Python's json.dumps writes it."""
    hex4 = lambda e: f"'\\u' || lpad(lower(to_hex({e})), 4, '0')"
    return f"""('"' || coalesce(array_to_string(list_transform(regexp_extract_all({expr}, '(?s).'), lambda c:
 CASE WHEN c = '"' THEN '\\"' WHEN c = '\\' THEN '\\\\' WHEN c = chr(10) THEN '\\n' WHEN c = chr(13) THEN '\\r'
 WHEN c = chr(9) THEN '\\t' WHEN c = chr(8) THEN '\\b' WHEN c = chr(12) THEN '\\f'
 WHEN unicode(c) >= 65536 THEN {hex4("55296 + (unicode(c) - 65536) // 1024")} || {hex4("56320 + (unicode(c) - 65536) % 1024")}
 WHEN unicode(c) < 32 OR unicode(c) >= 127 THEN {hex4("unicode(c)")} ELSE c END), ''), '') || '"')"""


def py_dict(*members: tuple[str, str]) -> str:
    """A JSON object; members are a literal name and a SQL expression of the written value."""
    inner = " || ', ' || ".join(f"'\"{name}\": ' || {value}" for name, value in members)
    return "('{' || " + inner + " || '}')"
