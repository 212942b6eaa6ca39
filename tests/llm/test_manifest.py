"""Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from exposcan.llm import manifest
from exposcan.llm.queries import QUERIES
from tests.llm.fixtures import ascii_lower, docs, frame

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [None if v is None else str(v) for v in (*row[:4], text)]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(digests):
    """Levels of (digest, siblings before, siblings after), and the root."""
    levels = []
    while len(digests) > 1:
        runs = [digests[k:k + 16] for k in range(0, len(digests), 16)]
        levels.append([("".join(r[:k]), "".join(r[k + 1:])) for r in runs for k in range(len(r))])
        digests = [digest("".join(r)) for r in runs]
    return levels, digests[0]


def expected(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of each row, sorted."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0], leaf(row, row[4]), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        inner[s] = tree([r[1] for r in by_source[s]])
    upper, root = tree([inner[s][1] for s in order])
    out = []
    for place, s in enumerate(order):
        levels, subroot = inner[s]
        for k, (i, own, row) in enumerate(by_source[s]):
            text = row[4]
            if text is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                text = ascii_lower(text)
            at, now, proof = k, leaf(row, text), ""
            for part, start in ((levels, k), (upper, place)):
                at = start
                for level in part:
                    left, right = level[at]
                    now, proof, at = digest(left + now + right), proof + left + right, at // 16
            out.append((i, own, subroot, root, digest(proof), now, now == root))
    return sorted(out, key=str)


def got(spark, rows, tmp_path, extra=""):
    made = frame(spark, rows, SCHEMA)
    if extra:
        made = made.selectExpr("*", *[f"'{c}' as {c}" for c in extra.split()])
    made.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [17], [300, 1, 16, 17], [2] * 20])
def test_shapes(spark, tmp_path, sizes):
    rng = random.Random(len(sizes) + sum(sizes))
    ids = rng.sample(range(-50, 5000), sum(sizes))
    rows = [(ids.pop(), f"s{k}", rng.choice(["en", None]), rng.choice([None, 3]), rng.choice(["Some Text", "plain", "ÄÖ X", ""])) for k, n in enumerate(sizes) for _ in range(n)]
    assert got(spark, rows, tmp_path) == expected(rows)


def test_nulls_ties_repeats_and_other_columns(spark, tmp_path):
    rows = [(5, None, None, None, None), (5, None, None, None, None), (5, "", "x", 0, ""), (None, "a", "x", 1, "A"), (None, "a", "x", 1, "B"), (5, "ä", "x", 1, "Z" * 100_000)]
    rows += [(7, "b", "x", 1, "Twin")] * 40 + [(k, "Z", "en", k, f"T{k}") for k in range(30)]
    found = got(spark, rows, tmp_path, "leaf digest idx tree run n members path node place up group row found at")
    assert found == expected(rows) and len(found) == len(rows)
    assert not all(r[6] for r in found)


def test_no_rows(spark, tmp_path):
    assert got(spark, [], tmp_path) == []


def test_one_group_is_numbered_by_several_tasks(spark):
    """No task numbers a whole source: the plan has no window over the rows."""
    made = manifest.manifest(docs(spark, [f"T{k}" for k in range(100)]))
    assert not re.search(r"\bWindow\b", made._jdf.queryExecution().toString())
    assert made.filter("verified").count() == 100
