"""Findings and identity records from JSON texts. Texts that do not parse yield no rows; see
``operators.report.quarantine`` for reporting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.ids import finding_id_index
from exposcan.functions.json_text import last_entries, last_members, one_json_value, python_json_text, python_str
from exposcan.functions.text import let
from exposcan.session import with_once


def value_or_empty(keys: Column, members: Column, key: str) -> Column:
    """The value under ``key``; empty when the key is missing, null when it is null."""
    return F.when(F.map_contains_key(keys, F.lit(key)), members[key]).otherwise(F.lit(""))


def _members(files: DataFrame, file: str, json: str) -> DataFrame:
    """``file, email, keys, text`` of the last member of each key; ``keys`` is null if it is no object."""
    parsed = F.from_json(one_json_value(F.col(json)), "map<string,string>")
    return files.select(F.col(file).alias("file"), F.explode(last_entries(parsed)).alias("entry")).select(
        "file", F.col("entry.key").alias("email"), F.from_json("entry.value", "map<string,string>").alias("keys"), F.col("entry.value").alias("text")
    )


def odd_members(files: DataFrame, file: str, json: str) -> DataFrame:
    """``file, email`` of members that are no objects; they give no finding and are to be reported."""
    return _members(files, file, json).where(F.col("keys").isNull()).select("file", "email")


def _entries(files: DataFrame, file: str, json: str, names: list[str]) -> DataFrame:
    found = _members(files, file, json).where(F.col("keys").isNotNull())
    return found.withColumn("details", last_members(F.col("text"), names))


def read_keyed_findings(files: DataFrame, file: str, json: str) -> DataFrame:
    """``file, email, email_context, id, origin`` of ``{email: {email_context, ID, FROM}}``."""
    keys, details = F.col("keys"), F.col("details")
    return _entries(files, file, json, ["email_context", "ID", "FROM"]).select(
        "file",
        "email",
        value_or_empty(keys, details, "email_context").alias("email_context"),
        value_or_empty(keys, details, "ID").alias("id"),
        value_or_empty(keys, details, "FROM").alias("origin"),
    )


def read_object_findings(files: DataFrame, file: str, json: str) -> DataFrame:
    """``file, email, email_context, id`` of ``{email: {email_context}}``; the id is computed."""
    rows = _entries(files, file, json, ["email_context"]).select(
        "file", "email", value_or_empty(F.col("keys"), F.col("details"), "email_context").alias("email_context")
    )
    # A null context hashes as the word a Python format string writes for it.
    context = F.coalesce(F.col("email_context"), F.lit("None"))
    return rows.withColumn("id", finding_id_index(F.col("email"), context))


def read_array_findings(files: DataFrame, file: str, json: str) -> DataFrame:
    """``file, seq, email, email_context, id`` of ``[{email, email_context}]``.

    An item counts when it has both keys, null or not. Object contexts are written out as
    Python writes dicts; other values as ``str`` does.
    """
    texts = F.from_json(one_json_value(F.col(json)), "array<string>")
    both = lambda m: F.map_contains_key(m, F.lit("email")) & F.map_contains_key(m, F.lit("email_context"))
    items = files.select(F.col(file).alias("file"), F.posexplode(texts).alias("seq", "text")).select(
        "file",
        "seq",
        F.from_json("text", "map<string,string>").alias("keys"),
        last_members(F.col("text"), ["email", "email_context"]).alias("item"),
        F.from_json("text", "email_context map<string,string>")["email_context"].isNotNull().alias("is_object"),
        (
            F.from_json("text", "email_context array<string>")["email_context"].isNotNull()
            | F.from_json("text", "email_context boolean")["email_context"].isNotNull()
            | F.from_json("text", "email_context double")["email_context"].isNotNull()
        ).alias("is_value"),
    ).where(both(F.col("keys")))
    raw = F.col("item.email_context")
    context = (
        F.when(F.col("is_object"), python_json_text(raw)).when(F.col("is_value"), python_str(raw))
        .otherwise(F.coalesce(raw, F.lit("None")))
    )
    rows = items.select("file", "seq", F.col("item.email").alias("email"), context.alias("email_context"))
    return rows.withColumn("id", finding_id_index(F.col("email"), F.col("email_context")))


def read_identity_json(files: DataFrame, file: str, json: str) -> DataFrame:
    """``file`` and the identity fields of objects with an ``Information`` key; missing ones empty.

    Every text is parsed once per step, whatever is filtered later: filters would be pushed below the parses and repeat them.
    """
    members = one_json_value(F.col("json"))
    text = let(members, lambda text: last_members(text, ["Information"]))["Information"]
    informed = with_once(files.select(F.col(file).alias("file"), F.col(json).alias("json")), text=text)
    keys, info = identity_members(F.col("text"))
    rows = with_once(informed.select("file", "text"), keys=keys, info=info)
    return identity_fields(rows.where(F.col("keys").isNotNull()), "file")


def identity_members(text: Column) -> list[Column]:
    """``keys``, null if the text is no object, and ``info``, the identity fields in it."""
    return [F.from_json(text, "map<string,string>").alias("keys"), last_members(text, fv.IDENTITY_FIELDS).alias("info")]


def identity_fields(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, *[value_or_empty(F.col("keys"), F.col("info"), name).alias(name) for name in fv.IDENTITY_FIELDS])
