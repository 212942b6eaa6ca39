"""Contexts of addresses in a line.

A context is cut around the first place its address occurs *as a string*, which may lie
inside a longer address further left. Searching the line for every address costs the product
of both lengths, and dumps do hold a million addresses on one line, so above a fixed amount
of work the ``@`` signs are sorted instead: an address ``l@d`` can only sit at signs whose
reversed left side starts with ``l`` reversed, and those are neighbours in that order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.text import let, line_context, strip

_DIRECT_WORK = 100_000
_LOOK_AHEAD = 16
_LOCAL_RUN = r"(?<![a-zA-Z0-9._%+-])[a-zA-Z0-9._%+-]*+\z"
_DOMAIN_HEAD = r"\A[a-zA-Z0-9-]*+(?:\.[a-zA-Z]++)?+"


def line_contexts(line: Column, emails: Column, radius: int = fv.LINE_CONTEXT) -> Column:
    """``array<struct<email, email_context>>`` for distinct, strictly valid addresses of ``line``."""

    def direct(found: Column) -> Column:
        return F.transform(found, lambda e: _result(e, line_context(line, e, radius)))

    return let(emails, lambda found: F.when(
        F.size(found).cast("bigint") * F.length(line) <= _DIRECT_WORK, direct(found)
    ).otherwise(_by_sorted_signs(line, found, radius)))


def _result(email: Column, context: Column) -> Column:
    return F.struct(email.alias("email"), context.alias("email_context"))


def _by_sorted_signs(line: Column, emails: Column, radius: int) -> Column:
    def around(pieces: Column) -> Column:
        signs = F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 1),
            lambda j: _entry(
                F.regexp_extract(F.element_at(pieces, j), _LOCAL_RUN, 0),
                F.regexp_extract(F.element_at(pieces, j + 1), _DOMAIN_HEAD, 0),
                j,
                F.lit(None).cast("string"),
            ),
        )
        longest = F.array_max(F.transform(emails, F.length))
        cut = let(longest + radius, lambda reach: F.struct(
            F.transform(pieces, lambda p: F.right(p, reach)).alias("tails"),
            F.transform(pieces, lambda p: F.left(p, reach)).alias("heads"),
        ))
        return let(F.sort_array(signs), lambda sorted_signs: let(
            F.sort_array(F.concat(_first_of_equals(sorted_signs), F.transform(emails, _question))),
            lambda entries: let(cut, lambda c: _answers(line, entries, c, radius)),
        ))

    return let(F.split(line, "@", -1), around)


def _entry(local: Column, domain: Column, sign: Column, email: Column) -> Column:
    return F.struct(
        F.substring_index(domain, ".", 1).alias("label"),
        F.reverse(local).alias("lacol"),
        domain.alias("domain"),
        sign.alias("sign"),
        email.alias("email"),
    )


def _question(email: Column) -> Column:
    """Sorts just before every sign the address may sit at."""
    local, domain = F.substring_index(email, "@", 1), F.substring_index(email, "@", -1)
    return F.struct(
        F.substring_index(domain, ".", 1).alias("label"),
        F.reverse(local).alias("lacol"),
        F.lit("").alias("domain"),
        F.lit(0).alias("sign"),
        email.alias("email"),
    )


def _first_of_equals(signs: Column) -> Column:
    def is_first(s: Column, i: Column) -> Column:
        before = F.get(signs, i - 1)
        same = (before["label"] == s["label"]) & (before["lacol"] == s["lacol"]) & (before["domain"] == s["domain"])
        return (i == 0) | ~same

    return F.filter(signs, is_first)


def _answers(line: Column, entries: Column, cut: Column, radius: int) -> Column:
    def answer(q: Column, i: Column) -> Column:
        def pick(ahead: Column) -> Column:
            in_range = lambda s: (s["label"] == q["label"]) & s["lacol"].startswith(q["lacol"])
            domain = F.substring_index(q["email"], "@", -1)
            hits = F.filter(ahead, lambda s: s["email"].isNull() & in_range(s) & s["domain"].startswith(domain))
            more = F.coalesce(in_range(F.get(ahead, F.lit(_LOOK_AHEAD - 1))), F.lit(False))
            found = let(
                F.array_min(F.transform(hits, lambda s: s["sign"])),
                lambda sign: _cut_at(sign, q["email"], cut, radius),
            )
            return F.when(more, line_context(line, q["email"], radius)).otherwise(found)

        context = let(F.slice(entries, i + 2, F.lit(_LOOK_AHEAD)), pick)
        return F.when(q["email"].isNotNull(), _result(q["email"], context))

    return F.filter(F.transform(entries, answer), lambda a: a.isNotNull())


def _cut_at(sign: Column, email: Column, cut: Column, radius: int) -> Column:
    before = F.length(F.substring_index(email, "@", 1)) + radius
    after = F.length(F.substring_index(email, "@", -1)) + radius
    tails, heads = cut["tails"], cut["heads"]

    def left_of(width: Column) -> Column:
        start = F.greatest(sign - width + 1, F.lit(1))
        return F.array_join(F.slice(tails, start, sign - start + 1), "@")

    def right_of(width: Column) -> Column:
        return F.array_join(F.slice(heads, sign + 1, width), "@")

    def enough(take, need: Column) -> Column:
        return let(take(F.lit(4)), lambda t: F.when(F.length(t) >= need, t).otherwise(take(need + 1)))

    return strip(F.concat(
        F.right(enough(left_of, before), before), F.lit("@"), F.left(enough(right_of, after), after)
    ))
