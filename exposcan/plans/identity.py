"""Identity records from model replies, with a run report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan import fixed_values as fv
from exposcan.functions.ids import empty_to_null
from exposcan.functions.json_text import falsy_members, json_block, last_members, one_json_value
from exposcan.operators.report import run_report
from exposcan.session import with_once
from exposcan.sources.findings_json import identity_fields, identity_members


def has_identity(row_name: Column, row_id: Column) -> Column:
    return (F.coalesce(row_name, F.lit("")) != "") | (F.coalesce(row_id, F.lit("")) != "")


def require_identity(records: DataFrame) -> DataFrame:
    return records.where(has_identity(F.col("Name"), F.col("`ID Number`")))


def judge_replies(replies: DataFrame, image: str, reply: str) -> DataFrame:
    """``file, status`` and the identity fields of every reply.

    ``error``: no JSON object, or ``Information`` is not an object; ``ignored``: no
    ``Information``; ``skipped``: neither name nor number; ``indexed``: the rest.
    """
    replied = with_once(
        replies.select(F.col(image).alias("file"), F.col(reply).alias("reply")), json=one_json_value(json_block(F.col("reply")))
    )
    parsed = with_once(
        replied.select("file", "json"), members=F.from_json("json", "map<string,string>"),
        text=last_members(F.col("json"), ["Information"])["Information"],
    )
    # A name or number that Python takes for false (0, false, empty) identifies nobody; such dates are no dates.
    judged = ["Name", "ID Number", *fv.IDENTITY_DATES]
    keys, info = identity_members(F.col("text"))
    found = with_once(parsed, keys=keys, info=info, false=falsy_members(F.col("text"), judged))
    false = {name: F.coalesce(F.col(f"false.`{name}`"), F.lit(True)) for name in judged}
    fields = identity_fields(found, "file", "members", "text", "keys", "false")
    status = (
        F.when(F.col("members").isNull(), "error")
        .when(~F.map_contains_key("members", F.lit("Information")), "ignored")
        .when(F.col("keys").isNull(), "error")
        .when(false["Name"] & false["ID Number"], "skipped")
        .otherwise("indexed")
    )
    dated = [
        F.when(~false[name], F.col(f"`{name}`")).otherwise("").alias(name) if name in fv.IDENTITY_DATES else F.col(f"`{name}`")
        for name in fv.IDENTITY_FIELDS
    ]
    return fields.select("file", status.alias("status"), *dated)


def identity_records(replies: DataFrame, image: str, reply: str, id_source: Column) -> DataFrame:
    """Records to append: empty dates are null; provenance is the image name."""
    kept = judge_replies(replies, image, reply).where(F.col("status") == "indexed")
    shaped = [
        empty_to_null(F.col(f"`{name}`")).alias(name) if name in fv.IDENTITY_DATES else F.col(f"`{name}`")
        for name in fv.IDENTITY_FIELDS
    ]
    return kept.select(*shaped, F.col("file").alias("FROM"), id_source.cast("int").alias("id_source"))


def identity_report(replies: DataFrame, image: str, reply: str) -> DataFrame:
    outcomes = judge_replies(replies, image, reply).select("file", "status")
    return run_report(outcomes.where(F.col("status") != "ignored"))
