"""Words and their positions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands between words: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_words(text: Column) -> Column:
    """Words of digits, letters and all characters beyond ASCII, lower-cased; none for null.

    Lower-casing beyond A-Z makes no ASCII letter but for the Kelvin sign, which is replaced before.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(plain, BETWEEN), "")


def at_positions(rows: DataFrame, words: str, length: int, name: str = "at") -> DataFrame:
    """A row for each place where ``length`` words start. ``words`` stays at hand and is not copied
    as long as only column functions and broadcast joins follow."""
    last = F.size(words) - length
    return rows.withColumn(name, F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))))


def run_hash(words: str, at: Column, offsets: tuple[int, ...]) -> Column:
    return F.xxhash64(*[F.get(words, at + n if n else at) for n in offsets])
