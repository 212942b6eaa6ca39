"""Address extraction.

The published patterns backtrack: on the JVM a long quoted run overflows the stack and a
long run without ``@`` costs quadratic time. The forms built here match the same
addresses in linear time:

* runs are possessive, which loses nothing because a run cannot contain what follows it;
* an atom may start a match only where a run starts, and not after ``atom.``, since the
  attempt from the head of that chain has already failed the same way. The place where the
  previous match ended (``\\G``) is exempt, as its chain was consumed and not tried;
* quoted local parts are tried only in texts that hold a quote followed by what must
  follow it, so texts full of quotes and escapes pay nothing for them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.text import let


@dataclass(frozen=True)
class AddressPattern:
    """``plain`` covers texts where no quoted local part can match, ``full`` the others."""

    plain: str
    full: str
    needs_full: str


def _class(members: str) -> str:
    """The same character class with its ASCII members listed one by one.

    The JVM tests listed characters by table and ranges one after the other; on texts the
    listed form is ten times faster.
    """
    test = re.compile(members)
    listed = "".join(f"\\x{code:02x}" for code in range(256) if test.match(chr(code)))
    beyond = r"\x{100}-\x{10ffff}" if test.match(chr(256)) else ""
    return f"[{listed}{beyond}]"


def _rfc(allow_pipe: bool) -> AddressPattern:
    pipe = "" if allow_pipe else r"\x7c"
    atom = _class(r"[^\x00-\x20\x22\x28\x29\x2c\x2e\x3a-\x3c\x3e\x40\x5b-\x5d\x7f-\xff%s]" % pipe)
    inside_quotes = _class(r"[^\x0d\x22\x5c\x80-\xff]")
    inside_brackets = _class(r"[^\x0d\x5b-\x5d\x80-\xff]")
    quoted = rf"\x22{inside_quotes}*+(?:\x5c[\x00-\x7f]{inside_quotes}*+)*+\x22"
    literal = rf"\x5b{inside_brackets}*+(?:\x5c[\x00-\x7f]{inside_brackets}*+)*+\x5d"
    label = f"(?:{atom}++|{literal})"
    domain = rf"\x40{label}\x2e{label}"
    head = rf"(?<!{atom})(?:(?<!{atom}\x2e)|(?<=\G\x2e)){atom}++"
    return AddressPattern(
        plain=rf"{head}(?:\x2e{atom}++)*+{domain}",
        full=rf"(?:{head}|{quoted})(?:\x2e(?:{atom}++|{quoted}))*+{domain}",
        needs_full=rf"\x22(?:\x2e(?:{atom}|\x22)|\x40(?:{atom}++\x2e|\x5b))",
    )


RFC = _rfc(allow_pipe=False)
RELAXED = _rfc(allow_pipe=True)
_LOCAL = _class("[a-zA-Z0-9._%+-]")
_SIMPLE_JAVA = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_class('[a-zA-Z0-9.-]')}+(?:\.[a-zA-Z]{{2,}})+"
SIMPLE = AddressPattern(plain=_SIMPLE_JAVA, full=_SIMPLE_JAVA, needs_full="")

_NO_STRINGS = "array<string>"


def _choose(text: Column, pattern: AddressPattern, build) -> Column:
    """``build`` with the cheapest pattern that is exact for this text."""
    if not pattern.needs_full:
        return build(pattern.plain)
    return F.when(text.rlike(pattern.needs_full), build(pattern.full)).otherwise(build(pattern.plain))


def find_all(text: Column, pattern: AddressPattern) -> Column:
    found = _choose(text, pattern, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)))
    return F.when(text.contains("@"), found).otherwise(F.array().cast(_NO_STRINGS))


def has_email(text: Column, pattern: AddressPattern = RFC) -> Column:
    found = F.coalesce(_choose(text, pattern, lambda p: text.rlike(p)), F.lit(False))
    return F.when(text.contains("@"), found).otherwise(F.lit(False))


def rfc_emails(text: Column) -> Column:
    return find_all(text, RFC)


def rfc_emails_relaxed(text: Column) -> Column:
    return find_all(text, RELAXED)


def simple_emails(text: Column) -> Column:
    return find_all(text, SIMPLE)


def valid_email(email: Column) -> Column:
    """Python's ``$`` stands at the end or before one final newline, not before other line ends."""
    return email.rlike(fv.STRICT_EMAIL.removesuffix("$") + r"\n?\z")


def mask_emails(text: Column, mark: str = "[email]") -> Column:
    """Replace every address, by either pattern, with ``mark``.

    The plain pattern goes first: it takes whole domains, the other would leave their tail.
    """
    once = F.regexp_replace(text, SIMPLE.plain, mark)
    return F.when(text.contains("@"), F.regexp_replace(once, RFC.full, mark)).otherwise(text)


def _between(text: Column, pattern: AddressPattern) -> Column:
    return _choose(text, pattern, lambda p: F.split(text, p, -1))


_CHUNK = 256


def email_offsets(text: Column, pattern: AddressPattern = RFC) -> Column:
    """``array<struct<email, start, end>>``, offsets in characters from 0.

    Offsets are running sums of piece lengths, taken per chunk so that a text with many
    addresses does not pay the square of their number.
    """

    def offsets(pieces: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _CHUNK).cast("int")),
            lambda c: F.slice(pieces, c * _CHUNK + 1, F.lit(_CHUNK)),
        )
        return let(chunks, lambda cs: let(F.transform(cs, _span), lambda spans: F.flatten(
            F.transform(cs, lambda chunk, c: _chunk_offsets(chunk, _total(F.slice(spans, 1, c)))))))

    def pieces(emails: Column) -> Column:
        return F.zip_with(
            _between(text, pattern),
            emails,
            lambda gap, email: F.struct(
                email.alias("email"),
                F.length(gap).alias("gap"),
                F.coalesce(F.length(email), F.lit(0)).alias("len"),
            ),
        )

    empty = F.array().cast("array<struct<email:string,start:int,end:int>>")
    return let(find_all(text, pattern), lambda emails: F.when(
        F.size(emails) > 0,
        let(F.slice(pieces(emails), F.lit(1), F.size(emails)), offsets),
    ).otherwise(empty))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _span(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0), lambda a, p: a + p["gap"] + p["len"])


def _chunk_offsets(chunk: Column, base: Column) -> Column:
    def place(piece: Column, i: Column) -> Column:
        start = base + _span(F.slice(chunk, 1, i)) + piece["gap"]
        return F.struct(
            piece["email"].alias("email"), start.alias("start"), (start + piece["len"]).alias("end")
        )

    return F.transform(chunk, place)


def emails_in_context(text: Column, radius: int, pattern: AddressPattern = RFC) -> Column:
    """``array<struct<pos, email, before, after>>``: each match with ``radius`` characters a side.

    Works on the pieces between matches, cut to ``radius``, so a match costs a bounded
    number of short pieces however long the text is. An address has at least five
    characters, which bounds the pieces a window can reach.
    """
    near, far = 7, 2 * (radius // 5 + 1) + 1

    def windows(pieces: Column) -> Column:
        tails = F.transform(pieces, lambda p: F.right(p, F.lit(radius)))
        heads = F.transform(pieces, lambda p: F.left(p, F.lit(radius)))
        matches = F.sequence(F.lit(1), F.floor(F.size(pieces) / 2).cast("int"))
        return let(F.struct(tails.alias("tails"), heads.alias("heads")), lambda cut: F.transform(
            matches, lambda i: _window(i, pieces, cut["tails"], cut["heads"])))

    def _window(i: Column, pieces: Column, tails: Column, heads: Column) -> Column:
        at = i * 2
        return F.struct(
            i.alias("pos"),
            F.element_at(pieces, at).alias("email"),
            reach(lambda w: _back(tails, at, w, radius), F.element_at(tails, at - 1)).alias("before"),
            reach(lambda w: _ahead(heads, at, w, radius), F.element_at(heads, at + 1)).alias("after"),
        )

    def reach(take, nearest: Column) -> Column:
        return F.when(F.length(nearest) >= radius, nearest).otherwise(
            let(take(near), lambda t: F.when(F.length(t) >= radius, t).otherwise(take(far)))
        )

    empty = F.array().cast("array<struct<pos:int,email:string,before:string,after:string>>")
    return F.when(text.contains("@"), let(_pieces(text, pattern), lambda pieces: F.when(
        F.size(pieces) > 1, windows(pieces)
    ).otherwise(empty))).otherwise(empty)


# A noncharacter: no text for interchange holds it. Texts that do are cut in two passes.
_MARK = chr(0xFDD0)


# The first quote after the start of a chunk closes a quoted local part, if one is open there.
_CLOSES = r'(?s)\A(?:[^"\\]|\\.)*+"[.@]'


def _marked(text: Column, pattern: AddressPattern) -> Column:
    """The text with a mark before and after each match.

    Only lines with ``@`` are searched, or sentences if there is one line: no atom or label holds a line end, nor a point before a
    space. Quoted parts and literals may; a quoted part that goes over the start of a chunk is closed by the chunk's first quote, and
    a literal follows ``@`` or a point. Texts where that may be are searched whole.
    """
    mark = lambda t: _choose(t, pattern, lambda p: F.regexp_replace(t, p, f"{_MARK}$0{_MARK}"))
    whole = mark(text)

    def by(separator: str, cut: str) -> Column:
        def searched(chunks: Column) -> Column:
            open_quote = F.exists(chunks, lambda c: c.contains("@") & c.contains('"') & c.rlike(_CLOSES))
            apart = F.transform(chunks, lambda c: F.when(c.contains("@"), mark(c)).otherwise(c))
            return F.when(open_quote, whole).otherwise(F.array_join(apart, separator))

        return let(F.split(text, cut, -1), searched)

    literal = text.contains("@[") | text.contains(".[")
    return F.when(literal, whole).when(text.contains("\n"), by("\n", "\n")).otherwise(by(". ", r"\. "))


def _pieces(text: Column, pattern: AddressPattern) -> Column:
    """What lies between matches and the matches, in turn, by marking them in one pass."""
    marked = _marked(text, pattern)
    paired = F.flatten(F.zip_with(_between(text, pattern), find_all(text, pattern), lambda g, m: F.array(g, m)))
    twice = F.slice(paired, F.lit(1), F.size(paired) - 1)
    return F.when(text.contains(_MARK), twice).otherwise(F.split(marked, _MARK, -1))


def _back(tails: Column, at: Column, width: int, radius: int) -> Column:
    start = F.greatest(at - width, F.lit(1))
    return F.right(F.array_join(F.slice(tails, start, at - start), ""), F.lit(radius))


def _ahead(heads: Column, at: Column, width: int, radius: int) -> Column:
    return F.left(F.array_join(F.slice(heads, at + 1, F.lit(width)), ""), F.lit(radius))
