"""Finding identifiers, names and small normalisers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan.functions.text import strip


def finding_id_text(email: Column, context: Column) -> Column:
    return F.sha1(F.concat(email, F.lit("_"), context))


def finding_id_doc(email: Column, context: Column) -> Column:
    return F.sha1(F.concat(email, context))


def finding_id_index(email: Column, context: Column) -> Column:
    return F.sha1(F.concat(F.lower(email), context))


def normalise_email(email: Column) -> Column:
    return F.lower(email)


def email_domain(email: Column) -> Column:
    """What stands between the first and the second ``@``; empty without one."""
    return F.lower(F.coalesce(F.get(F.split(email, "@", -1), F.lit(1)), F.lit("")))


def content_sha1(content: Column) -> Column:
    return F.sha1(content)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


# A suffix starts at the last dot that follows something other than leading dots.
_SUFFIX = r"(?s)[^.].*(\.[^.]*)\z"


def file_ext(path: Column) -> Column:
    return F.lower(F.ltrim(F.regexp_extract(base_name(path), _SUFFIX, 1), F.lit(".")))


def file_stem(path: Column) -> Column:
    name = base_name(path)
    return F.left(name, F.length(name) - F.length(F.regexp_extract(name, _SUFFIX, 1)))


def keyed_provenance(origin: Column, json_name: Column) -> Column:
    return F.concat(origin, F.lit(" "), json_name)


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def alnum_id(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def iso_utc(moment: Column) -> Column:
    """ISO-8601 in UTC without zone; the fraction appears only when there is one.

    A moment with a zone is moved to UTC, one without is taken to be UTC.
    """
    moved = F.to_utc_timestamp(moment, F.current_timezone())
    utc = F.when(F.typeof(moment) == "timestamp_ntz", moment.cast("timestamp")).otherwise(moved)
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(utc, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def utc_now_iso() -> Column:
    return iso_utc(F.current_timestamp())


def parse_int(text: Column) -> Column:
    """Integer or 0, for text as an ``int()`` call reads it."""
    digits = F.regexp_extract(strip(text), r"\A[+-]?[0-9]++(?:_[0-9]++)*+\z", 0)
    return F.coalesce(F.replace(digits, F.lit("_")).try_cast("int"), F.lit(0))
