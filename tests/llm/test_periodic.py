"""Periodic runs against a plain search of all periods."""

import hashlib
import random
import zlib

import pytest

from exposcan.llm import periodic
from exposcan.llm.queries import QUERIES, with_planted_runs
from tests.llm.fixtures import BLANKS, docs, frame, prose


def plain_runs(words):
    """Every maximal stretch of each period, the smallest period of a stretch first."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    # A stretch inside a longer one of a period that divides its own has that smaller period.
    out = []
    for (a, z), q in found.items():
        if not any(p < q and all(words[k] == words[k + p] for k in range(a, z - p)) for p in range(1, q)):
            out.append((a, z - a, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, BLANKS.findall(text or ""))
    runs = plain_runs(words)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-1 * (r[1] * 10**12 // r[2]), r[0], r[2]), default=None)
    milli = best and 1000 * best[1] // best[2]
    listed = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
    return (doc_id, len(runs), *(best or (None, None, None)), milli, digest(listed), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic_words(rng):
    """Prose with stretches of one period, some of them periodic in themselves, some overlapping."""
    out = []
    for _ in range(rng.randrange(1, 5)):
        unit = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13]))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(1, 4) + [rng.choice("abc")]
        length = int(len(unit) * rng.choice([1, 2.5, 3.9, 4, 4.3, 7]))
        out += (unit * 8)[:length]
        if rng.random() < 0.5:
            out += prose(rng, rng.randrange(4), 5)
    return out


@pytest.mark.parametrize("portion", [1, 3, 17, 1 << 16])
def test_catcher_in_portions(portion):
    rng = random.Random(portion)
    for _ in range(120):
        words = [w.encode() for w in periodic_words(rng)]
        assert periodic.runs_of(words, portion=portion) == plain_runs(words), words
    for text in ("", "a", "a " * 5, "a " * 6, "a b " * 4, "a b c " * 4, "a a b " * 30, "a " * 40 + "b " + "a " * 40):
        words = text.encode().split()
        assert periodic.runs_of(words, portion=portion) == plain_runs(words)


def test_other_thresholds():
    words = [w.encode() for w in "x a b a b a b a b a b a b y z z z z z z".split()]
    assert periodic.runs_of(words) == [(1, 12, 2), (14, 6, 1)]
    assert periodic.runs_of(words, least=7, times=5) == [(1, 12, 2)]
    with pytest.raises(ValueError):
        periodic.SquareCatcher(times=3)


def test_long_texts_take_linear_time():
    """A word a million times, and one period of 100,000 words: neither is compared over and over."""
    assert periodic.runs_of([b"a"] * 1_000_000) == [(0, 1_000_000, 1)]
    unit = [b"%d" % k for k in range(100_000)]
    assert periodic.runs_of([b"x", *unit * 4, b"y"]) == [(1, 400_000, 100_000)]


def test_query(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(periodic_words(rng)) for _ in range(60)] + [rng.choice([" ", "\n\t"]).join(prose(rng, rng.choice([1, 2, 7, 40, 300]), 40)) for _ in range(60)]
    texts += [None, "", " \x0b\x0c\r", "É " * 9, "a a " * 8, "w"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rows += [(None, "z " * 9, "en", "s", 0), *rows[:5], (rows[3][0], "other " * 8, None, None, None)]
    made = frame(spark, rows).selectExpr("*", "1 as runs", "2 as n", "3 as g", "4 as words", "5 as kept", "6 as strongest")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert sum(1 for r in got if r[1]) > 30


def test_planted_words(spark):
    texts = ["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 50
    got = with_planted_runs(docs(spark, texts)).collect()
    assert all(r["text"].split() == planted(r["doc_id"], texts[0].split()) for r in got)


def test_no_rows_and_odd_bytes(spark):
    assert periodic.periodic_runs(docs(spark, [])).collect() == []
    odd = spark.sql("select 1L as doc_id, cast(unhex('FF20FF20FF20FF20FF20FF20') as string) as text")
    assert periodic.periodic_runs(odd).first()["runs"] == [(0, 6, 1)]
