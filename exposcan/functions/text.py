"""String helpers shared by the lanes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposcan import fixed_values as fv


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A column captured by a lambda is evaluated per element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim every character Python's ``str.strip`` trims, not just the blank."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def unix_newlines(text: Column) -> Column:
    return F.when(text.contains("\r"), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)


def without_last_newline(text: Column) -> Column:
    """The text without its final newline, if it has one."""
    return F.when(text.endswith("\n"), F.left(text, F.length(text) - 1)).otherwise(text)


def lines_of(text: Column) -> Column:
    """Lines as a text-mode reader yields them: a final newline ends a line, it opens none."""
    body = without_last_newline(unix_newlines(text))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def replace_any(text: Column, old: str, new: str) -> Column:
    """``F.replace``, which compares at every byte, only for texts that hold ``old``."""
    return F.when(text.contains(old), F.replace(text, F.lit(old), F.lit(new))).otherwise(text)


def newline_to_space(text: Column) -> Column:
    return replace_any(text, "\n", " ")


def first_lines(text: Column, n: int) -> Column:
    """The first ``n`` lines joined by newlines; reading stops after line ``n``."""
    head = r"\A(?:[^\r\n]*+(?:\r\n?|\n)){0,%d}+[^\r\n]*+" % (n - 1)
    return F.when(text.contains("\r"), unix_newlines(F.regexp_extract(text, head, 0))).otherwise(F.substring_index(text, "\n", n))


def valid_utf8(text: Column) -> Column:
    """Drop the bytes that do not decode, keep the rest.

    The engine's repair writes U+FFFD for such bytes, so a genuine U+FFFD is parked on a
    noncharacter while the repair marks are removed.
    """
    mark, parked = F.lit(chr(0xFFFD)), F.lit(chr(0xFDD0) + chr(0xFDD1))
    repaired = F.replace(F.make_valid_utf8(F.replace(text, mark, parked)), mark, F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(repaired, parked, mark))


def line_context(line: Column, email: Column, radius: int = fv.LINE_CONTEXT) -> Column:
    """``radius`` characters each side of the first place the address string occurs."""

    def around(at: Column) -> Column:
        start = F.greatest(at - radius, F.lit(1))
        return strip(F.substring(line, start, at + F.length(email) + radius - start))

    return let(F.instr(line, email), around)


def split_pages(text: Column) -> Column:
    return F.split(text, "\n", -1)


def stripped_size(text: Column) -> Column:
    """Summary of a text piece that can be folded in order: see ``fold_sizes``."""
    left = F.ltrim(text, F.lit(fv.WHITESPACE))

    def cut(trimmed: Column) -> Column:
        """Characters are counted only where bytes tell that there are fewer."""
        fewer = F.octet_length(trimmed) < F.octet_length(text)
        return F.when(fewer, F.length(text) - F.length(trimmed)).when(text.isNotNull(), 0).cast("bigint")

    return F.struct(
        (left == "").alias("blank"),
        F.length(text).cast("bigint").alias("n"),
        cut(left).alias("lead"),
        cut(F.rtrim(text, F.lit(fv.WHITESPACE))).alias("trail"),
    )


def fold_sizes(pieces: Column) -> Column:
    """Combine ordered piece summaries into the summary of their concatenation."""
    empty = F.struct(
        F.lit(True).alias("blank"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("lead"),
        F.lit(0).cast("bigint").alias("trail"),
    )
    return F.aggregate(
        pieces,
        empty,
        lambda a, b: F.struct(
            (a["blank"] & b["blank"]).alias("blank"),
            (a["n"] + b["n"]).alias("n"),
            F.when(a["blank"], a["n"] + b["lead"]).otherwise(a["lead"]).alias("lead"),
            F.when(b["blank"], a["trail"] + b["n"]).otherwise(b["trail"]).alias("trail"),
        ),
    )


def stripped_length(summary: Column) -> Column:
    return F.when(summary["blank"], F.lit(0).cast("bigint")).otherwise(
        summary["n"] - summary["lead"] - summary["trail"]
    )


def python_float(number: Column) -> Column:
    """A finite number as Python writes floats: positional from 1e-4 to 1e16, else ``1e+16`` or ``1.5e-05``.

    The fewest digits that give the number back; the engine's own text may have one more.
    """
    number = number.cast("double")
    digits = [F.format_string(f"%.{n}e", number) for n in (14, 15, 16)]
    short = F.when(digits[0].cast("double") == number, digits[0]).when(digits[1].cast("double") == number, digits[1]).otherwise(digits[2])

    def written(text: Column) -> Column:
        positional = F.regexp_replace(text.cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0*\z", "$1")
        mantissa = F.regexp_replace(F.regexp_extract(text, r"\A([^e]*)e", 1), r"\.?0+\z", "")
        return (
            F.when(number == 0, number.cast("string")).when((F.abs(number) >= 1e-4) & (F.abs(number) < 1e16), positional)
            .otherwise(F.concat(mantissa, F.regexp_extract(text, r"(e.*)\z", 1)))
        )

    return let(short, written)
