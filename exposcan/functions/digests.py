"""A digest of a file that does not depend on how the file is cut.

The lines of a file, cut at line feeds only, are the coefficients of polynomials over a prime field: line ``i`` adds its hash
times ``base ** i``. Sums over any rows are therefore summed up in any order, and a split whose rows start at
``r`` is shifted to its place by a power of the base. So each split shrinks to a few numbers in the scan,
and a file's digest is folded from these in order. With the size of the file, lines determine its bytes: only whether the last
line ends in a line feed is open, and the size tells.

Four fields of 31 bits keep products within a ``bigint``; the exclusive or of all line hashes goes with them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749, 1_426_830_353, 1_801_741_777)
_BITS = 7
_SIDE = 1 << _BITS
#: Row numbers of a task have 33 bits.
_ROW = (1 << 33) - 1


def _power(base: int, exponent: str, bits: int) -> str:
    """SQL of ``base ** exponent`` in the field: a table lookup per ``_BITS`` bits of the exponent.

    A table is one constant: as an array of literals, every rule of the optimizer would walk through all of them.
    """
    out = ""
    for digit in range(-(-bits // _BITS)):
        step = pow(base, _SIDE**digit, PRIME)
        table = f"cast(split('{','.join(str(pow(step, k, PRIME)) for k in range(_SIDE))}', ',') as array<bigint>)"
        factor = f"get({table}, cast(shiftright({exponent}, {_BITS * digit}) & {_SIDE - 1} as int))"
        out = f"({out} * {factor} % {PRIME})" if out else factor
    return out


def line_terms(line: str, place: str) -> list[Column]:
    """What a line adds to its split: ``hash`` and a term per field. ``place`` grows by one per line of a task."""
    whole, row = f"xxhash64({line})", f"({place} & {_ROW})"
    terms = [f"pmod(xxhash64({whole}, {k}), {PRIME}) * {_power(base, row, 33)} % {PRIME} AS sum_{k}" for k, base in enumerate(BASES)]
    return [F.expr(e) for e in (f"{whole} AS hash", *terms)]


def summed_terms() -> list[Column]:
    """Aggregates of ``line_terms`` over the lines of a split; rows that are no lines have nulls there."""
    return [F.count("hash").alias("lines"), F.bit_xor("hash").alias("hash"), *[F.sum(f"sum_{k}").alias(f"sum_{k}") for k in range(len(BASES))]]


def file_digest(splits: str, size: str) -> Column:
    """Digest from ``array<struct<block, place, lines, hash, sum_...>>`` in file order; ``place`` is the first line's."""
    sums = []
    for k, base in enumerate(BASES):
        back = _power(pow(base, -1, PRIME), f"(s.place & {_ROW})", 33)
        sums.append(f"(t.sum_{k} + s.sum_{k} % {PRIME} * {back} % {PRIME} * {_power(base, 't.lines', 49)} % {PRIME}) % {PRIME} AS sum_{k}")
    start = ", ".join(["0L AS lines", "0L AS hash", *[f"0L AS sum_{k}" for k in range(len(BASES))]])
    step = ", ".join(["t.lines + s.lines AS lines", "t.hash ^ s.hash AS hash", *sums])
    folded = f"aggregate({splits}, struct({start}), (t, s) -> struct({step}), t -> array(t.lines, t.hash, {', '.join(f't.sum_{k}' for k in range(len(BASES)))}))"
    return F.expr(f"sha1(concat_ws('-', cast({size} as string), cast({folded} as array<string>)))")
