"""Delimited text and record fields.

A record is ``array<struct<name, value, raw>>`` in column order. ``raw`` marks values that are
JSON literals rather than text (typed sheet cells, surplus csv cells); only text is searched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan.functions.emails import RFC, SIMPLE, AddressPattern, has_email
from exposcan.functions.json_text import json_quote
from exposcan.functions.text import let, newline_to_space, unix_newlines

FIELDS = "array<struct<name:string,value:string,raw:boolean>>"

# A cell opens with a quote or runs to the next delimiter; after a closing quote the rest of
# the cell is plain. A quote that never closes takes the rest of the text.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+(?:"[^,\n]*+|\z)|[^",\n][^,\n]*+|(?=[,\n]|\z))'
_RECORD = rf"({_CELL}(?:,{_CELL})*+)(?:\n|\z)"
_ONE_CELL = rf"(?:\A|(?<=\G,)){_CELL}"


def csv_rows(text: Column) -> Column:
    """Record texts, the header first; quoted newlines stay inside a record.

    Empty lines are no records, but an empty first line is a header without columns.
    """
    rows = F.regexp_extract_all(unix_newlines(text), F.lit(_RECORD), F.lit(1))
    return F.filter(rows, lambda r, i: (i == 0) | (r != ""))


def csv_header(text: Column) -> Column:
    """The first of ``csv_rows``; reading stops there."""
    return F.regexp_extract(unix_newlines(text), _RECORD, 1)


def csv_cells(record: Column) -> Column:
    cells = F.regexp_extract_all(record, F.lit(_ONE_CELL), F.lit(0))
    read = F.transform(cells, lambda c: F.when(c.startswith('"'), _unquote(c)).otherwise(c))
    return F.when(record == "", F.array().cast("array<string>")).otherwise(read)


def _unquote(cell: Column) -> Column:
    """Cells that end with the quote that closes them, which most do, are cut without patterns."""
    doubled, quote = F.lit('""'), F.lit('"')
    closed = lambda inner: F.when(~inner.contains('"'), inner).when(
        ~F.replace(inner, doubled, F.lit("")).contains('"'), F.replace(inner, doubled, quote)).otherwise(_unquote_any(cell))
    return F.when(cell.endswith('"'), let(F.substring(cell, F.lit(2), F.length(cell) - 2), closed)).otherwise(_unquote_any(cell))


def _unquote_any(cell: Column) -> Column:
    inside = F.regexp_extract(cell, r'(?s)\A"([^"]*+(?:""[^"]*+)*+)', 1)
    after = F.regexp_extract(cell, r'(?s)\A"[^"]*+(?:""[^"]*+)*+"(.*)\z', 1)
    return F.concat(F.replace(inside, F.lit('""'), F.lit('"')), after)


def csv_columns(header: Column) -> Column:
    """``array<struct<name, at>>``: a repeated name keeps its first place, its last value."""
    names = csv_cells(header)
    return let(names, lambda ns: F.transform(
        F.array_distinct(ns),
        lambda n: F.struct(
            n.alias("name"),
            (F.size(ns) - F.array_position(F.reverse(ns), n).cast("int")).alias("at"),
        ),
    ))


def csv_fields(columns: Column, width: Column, record: Column) -> Column:
    """Fields of one record: missing cells are null, surplus ones sit under a null name."""

    def fields(cells: Column) -> Column:
        named = F.transform(columns, lambda c: F.struct(
            c["name"].alias("name"), F.get(cells, c["at"]).alias("value"), F.lit(False).alias("raw")))
        surplus = F.slice(cells, width + 1, F.greatest(F.size(cells) - width, F.lit(0)))
        as_list = F.concat(F.lit("["), F.array_join(F.transform(surplus, json_quote), ", "), F.lit("]"))
        extra = F.array(F.struct(
            F.lit(None).cast("string").alias("name"), as_list.alias("value"), F.lit(True).alias("raw")))
        return F.when(F.size(cells) > width, F.concat(named, extra)).otherwise(named)

    return let(csv_cells(record), fields)


def clean_values(fields: Column) -> Column:
    return F.transform(fields, lambda f: F.struct(
        f["name"].alias("name"), newline_to_space(f["value"]).alias("value"), f["raw"].alias("raw")))


def _holds_email(field: Column, pattern: AddressPattern) -> Column:
    return ~field["raw"] & has_email(field["value"], pattern)


def may_have_email(fields: Column) -> Column:
    """False only if no field holds an address."""
    return F.exists(fields, lambda f: ~f["raw"] & F.coalesce(f["value"].contains("@"), F.lit(False)))


def has_email_field(fields: Column, pattern: AddressPattern = SIMPLE) -> Column:
    return F.exists(fields, lambda f: _holds_email(f, pattern))


def first_email_field(fields: Column, whole_cell: bool) -> Column:
    """``struct<name, email>`` of the first field, in column order, that holds an address.

    ``whole_cell`` takes the cell as it stands, else the first address in it.
    """
    pattern = RFC if whole_cell else SIMPLE
    hit = F.get(F.filter(fields, lambda f: _holds_email(f, pattern)), F.lit(0))

    def pick(f: Column) -> Column:
        email = f["value"] if whole_cell else F.regexp_extract(f["value"], SIMPLE.plain, 0)
        return F.when(f.isNotNull(), F.struct(f["name"].alias("name"), email.alias("email")))

    return let(hit, pick)


def record_context(fields: Column, email_field: Column) -> Column:
    """The fields not named as the email field."""
    return F.filter(fields, lambda f: ~f["name"].eqNullSafe(email_field))
