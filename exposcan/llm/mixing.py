"""Mixing to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The tokens of the cells are the first weights; in
turn the weights are scaled to the target share of each source, language and topic, until all three agree.
A document is then kept with a probability in proportion to weight by tokens of its cell, scaled so that
the expected number of tokens is the wanted part of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposcan.llm.storage import settle

#: Rounds of fitting over the three margins, and of scaling the probabilities.
ROUNDS, SCALINGS = 8, 6
#: Target shares go with the tokens to this power: below 1, large sources give way to small ones.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
#: Part of all tokens that is to be kept.
KEPT = 0.5
#: Cells up to this number go to every task (some 60 bytes each).
BROADCAST_CELLS = 100_000

CELL = ["source", "lang", "topic"]


def topic_of(text: Column) -> Column:
    """A coarse topic by marks in the text."""
    return (
        F.when(F.contains(text, F.lit("icense")), "legal").when(F.contains(text, F.lit("@")), "contact")
        .when(F.contains(text, F.lit(" | ")), "table").otherwise("prose")
    )


def _cells_of(docs: DataFrame) -> DataFrame:
    """``docs`` with its cell and number of tokens; nulls in source and language are values of their own."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tokens = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    named = {"source": "source", "lang": "lang"}
    return docs.select(
        "*", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(f"_{k}") for k, c in named.items()],
        topic_of(text).alias("_topic"), tokens.alias("_tokens"),
    )


def fitted_cells(cells: DataFrame, powers: dict[str, float] = POWERS, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens > 0) with ``weight``, whose margins are the target shares.

    Target shares of a margin are its tokens to the given power, made to add up to 1. Cells without
    tokens stay without weight, so margins that cannot all be met agree as far as the cells allow.
    """
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    goals = {}
    for name, power in powers.items():
        margin = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("t")).withColumn("p", F.pow("t", F.lit(power)))
        total = margin.agg(F.sum("p")).first()[0] or 1.0
        goals[name] = settle(margin.select(name, (F.col("p") / F.lit(total)).alias("goal")), f"goal-{name}")
    for _ in range(rounds):
        for name in powers:
            margin = fitted.groupBy(name).agg(F.sum("weight").alias("now")).join(goals[name], name).select(name, (F.col("goal") / F.col("now")).alias("factor"))
            fitted = fitted.join(margin, name).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        fitted = settle(fitted.select(*cells.columns, "weight"), "fitted")
    return fitted


def calibrated(fitted: DataFrame, kept: float = KEPT, scalings: int = SCALINGS) -> DataFrame:
    """``fitted`` with ``probability``: min(1, c * weight / tokens), c such that ``kept`` of all tokens are expected.

    What cells at probability 1 cannot give is asked of the others in the next scaling.
    """
    ratio, c = F.col("weight") / F.col("tokens"), 0.0
    goal = kept * float(fitted.agg(F.sum("tokens")).first()[0] or 0)
    for _ in range(scalings):
        full = ratio * F.lit(c) >= 1
        given, open_ = fitted.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not open_:
            break
        c = (goal - float(given or 0)) / float(open_)
    return fitted.withColumn("probability", F.least(F.lit(1.0), ratio * F.lit(c)))


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) from 32 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in columns])), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _drawn(docs: DataFrame) -> DataFrame:
    celled = _cells_of(docs)
    cells = celled.groupBy(*[f"_{c}" for c in CELL]).agg(F.sum("_tokens").alias("tokens")).filter("tokens > 0")
    cells = settle(cells.toDF(*CELL, "tokens"), "cells")
    chances = settle(calibrated(fitted_cells(cells)), "chances")
    chances = chances.select(*[F.col(c).alias(f"_{c}") for c in CELL], F.col("weight").alias("_weight"), F.col("probability").alias("_probability"))
    few = chances.count() <= BROADCAST_CELLS
    # Without tokens a document adds nothing to any share; it is not kept.
    return celled.join(F.broadcast(chances) if few else chances, [f"_{c}" for c in CELL], "left").withColumn("_probability", F.when(F.col("_tokens") > 0, F.col("_probability")).otherwise(0.0))


def mixture(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text, source, lang): its cell, tokens, weight, probability, kept.

    ``cell_weight`` is the fitted share of its cell in all tokens, rounded to 6 digits as is ``probability``.
    A document is kept if a number drawn by its doc_id is below its probability, so repeated rows are kept or
    dropped together; a null id draws the same number each time. Null or empty texts have no
    tokens, probability 0 and are not kept. Other columns are ignored.
    """
    drawn = _drawn(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang")))
    probability = F.round("_probability", 6)
    return drawn.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.round(F.coalesce("_weight", F.lit(0.0)), 6).alias("cell_weight"), probability.alias("probability"),
        (uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("mix")) < probability).alias("kept"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, whatever their names."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "source", "lang")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return _drawn(packed).filter(uniform(key, F.lit("mix")) < F.round("_probability", 6)).select("row.*")
