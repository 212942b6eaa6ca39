"""Licence scans by diagonal voting.

Every run of three words of a text is joined by its hash to the places where known licence wordings
have it. A hit votes for the diagonal "place in the text minus place in the wording". On
one diagonal lies a wording repeated word for word; inserted or missing words move the rest to a neighbouring
one, so diagonals close to each other are merged. The span is verified by the share of the
wording's runs it holds, compared as words, by its length, and by the runs that tell the wording from others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from exposcan.llm.native_words import ascii_words, at_positions, run_hash

RUN = 3
#: Diagonals at most so far apart are merged.
BAND = 4
#: Share of a wording's runs that a span must hold, and its most words per word of the wording.
COVERED, STRETCH = 0.6, 1.5
#: Runs with the name or version of a licence, which a span must hold if its wording does.
TELLING = ("gnu general public", "license version 2", "license version 3")

# Phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening words of public licence notices.
WORDINGS = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution noncommercial": "cc-by-nc",
    "this work is licensed under a creative commons attribution sharealike": "cc-by-sa",
}


def _runs(phrase: str) -> list[str]:
    words = phrase.split()
    return [" ".join(words[at:at + RUN]) for at in range(len(words) - RUN + 1)]


def telling_places(wordings: dict[str, str]) -> list[list[list[int]]]:
    """For each wording lists of places; a span must hold one of each list.

    A list has the places of a run of TELLING, or those of the runs a wording with another label lacks that
    holds COVERED of its runs.
    """
    found = []
    for phrase, label in wordings.items():
        runs = _runs(phrase)
        lists = [[at for at, run in enumerate(runs) if run == name] for name in TELLING]
        for other in (p for p, v in wordings.items() if v != label):
            lacks = [at for at, run in enumerate(runs) if run not in _runs(other)]
            if len(runs) - len(lacks) >= COVERED * len(runs):
                lists.append(lacks)
        found.append([places for places in lists if places])
    return found


def license_scan(docs: DataFrame, base: dict[str, str] = BASE, wordings: dict[str, str] = WORDINGS) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text).

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: number, smallest and largest start of the places where
    the words of a base phrase stand one after another; ``base_labels``; ``labels``, those
    and the ones found by voting; ``score``, the largest verified share of a wording, 1 with a base phrase and 0 without any.
    Null and empty texts have no words. Rows with equal id and text get equal results, rows that
    differ in either are told apart; null ids are allowed. Other columns are ignored. Phrases have at least
    three words; their table goes to every task and is as large as the dictionaries given.
    """
    spark = docs.sparkSession
    table = []
    for number, (phrase, label, exact) in enumerate([*((p, v, True) for p, v in base.items()), *((p, v, False) for p, v in wordings.items())]):
        table += [(number, label, exact, len(_runs(phrase)), at, run) for at, run in enumerate(_runs(phrase))]
    runs = spark.createDataFrame(table, "wording int, label string, exact boolean, runs int, place int, run string")
    runs = runs.withColumn("hash", F.xxhash64(*[F.split("run", " ")[k] for k in range(RUN)]))

    needed = [*([] for _ in base), *telling_places(wordings)]
    needed = F.array(*[F.array(*[F.array(*map(F.lit, places)) for places in lists]).cast("array<array<int>>") for lists in needed])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), ascii_words(F.col("text").cast("string")).alias("words"))
    key = ["doc_id", "print"]
    at = F.col("at")
    hashed = at_positions(rows, "words", RUN).withColumn("hash", run_hash("words", at, (0, 1, 2)))
    hits = hashed.join(F.broadcast(runs), "hash").filter(F.concat_ws(" ", *[F.get("words", at + k) for k in range(RUN)]) == F.col("run"))

    votes = hits.select(*key, "wording", "label", "exact", "runs", "place", (at - F.col("place")).alias("diagonal"))
    votes = votes.groupBy(*key, "wording", "label", "exact", "runs", "diagonal").agg(F.collect_set("place").alias("places"))
    side = W.partitionBy(*key, "wording").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(side)
    # A base phrase counts for each place, so its diagonals stay apart.
    opens = F.when(F.col("exact") | gap.isNull() | (gap > BAND), 1).otherwise(0)
    spans = votes.withColumn("opens", opens).withColumn("span", F.sum("opens").over(side))
    spans = spans.groupBy(*key, "wording", "label", "exact", "runs", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("places") + RUN).alias("end"),
    )
    spans = spans.withColumn("held", F.size("places"))
    share = F.col("held") / F.col("runs")
    found = spans.withColumn("share", share).filter(
        F.when(F.col("exact"), F.col("held") == F.col("runs"))
        .otherwise((F.col("share") >= COVERED) & (F.col("end") - F.col("start") <= STRETCH * (F.col("runs") + RUN - 1)))
    ).filter(F.forall(F.get(needed, F.col("wording")), lambda places: F.arrays_overlap(places, F.col("places"))))
    only_base = lambda value: F.when(F.col("exact"), value)
    joined = lambda value: F.array_join(F.array_sort(F.collect_set(value)), ",")
    per_doc = found.groupBy(*key).agg(
        F.count(only_base(F.col("start"))).alias("n_base"),
        F.min(only_base(F.col("start"))).cast("long").alias("first_word"),
        F.max(only_base(F.col("start"))).cast("long").alias("last_word"),
        joined(only_base(F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("share").alias("score"),
    )
    counted = rows.select(*key, F.size("words").cast("long").alias("n_words"))
    same = counted["doc_id"].eqNullSafe(per_doc["doc_id"]) & (counted["print"] == per_doc["print"])
    return counted.join(per_doc, same, "left").select(
        counted["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
