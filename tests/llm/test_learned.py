"""Classifiers by held-out accuracy, neighbours by recall."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from exposcan.llm import ann, quality, toxicity
from exposcan.llm.labelled import fold
from tests.llm.fixtures import docs, frame, prose


def labelled(seed, n=500):
    rng = random.Random(seed)
    bad = ["grumpf", "zonkers", "blarghed"]
    texts, rows = [], []
    for k in range(n):
        words = prose(rng, rng.randrange(20, 200), 400)
        toxic, poor = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        if poor:
            words = [w + rng.choice(["%%%", "$$$", "!!"]) for w in words]
        texts.append(" ".join(words))
        rows.append((k, int(not poor), int(toxic)))
    return texts, rows


@pytest.fixture(scope="module")
def scored(spark):
    texts, rows = labelled(1)
    labels = frame(spark, [*rows, (None, 1, 1), (3, None, None), (10_000, 1, 0)], "doc_id long, quality int, toxic int")
    more = [*enumerate(texts), (7, texts[7]), (600, None), (601, ""), (602, "x " * 100_000), (None, texts[0])]
    frame_ = docs(spark, more).withColumnRenamed("lang", "score").withColumnRenamed("source", "label")
    return rows, frame_, labels, {"toxic": toxicity.toxicity(frame_, labels).collect(), "quality": quality.quality(frame_, labels).collect()}


@pytest.mark.parametrize(("name", "at", "folds", "out"), [("quality", 1, 5, 0), ("toxic", 2, 4, 2)])
def test_held_out_accuracy(scored, name, at, folds, out):
    rows, _, _, found = scored
    truth = {r[0]: r[at] for r in rows}
    right = []
    for r in found[name]:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == out)
        if r["held_out"] and r["doc_id"] in truth:
            right.append(r["predicted"] == truth[r["doc_id"]])
    assert len(right) > 50 and sum(right) >= 0.93 * len(right)
    assert len(found[name]) == 505 and len({r["score"] for r in found[name] if r["doc_id"] == 7}) == 1


def test_labels_of_the_held_out_teach_nothing(spark, scored):
    rows, frame_, _, found = scored
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in rows]
    labels = frame(spark, flipped, "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(frame_, labels).collect()}
    assert again == {r["doc_id"]: r["score"] for r in found["toxic"]}


def test_no_labels(spark):
    texts = docs(spark, ["a b", None])
    none = frame(spark, [], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.toxicity(texts, none).collect()] == [0, 0]
    assert [r["predicted"] for r in quality.quality(texts, none).collect()] == [1, 1]
    assert toxicity.toxicity(texts.filter("false"), none).collect() == []
    kept = toxicity.without_toxic(texts, none)
    assert kept.columns == texts.columns and kept.count() == 2


def test_fold(spark):
    got = frame(spark, [(k,) for k in (0, 7, 123456789)], "doc_id long").select("doc_id", fold(F.col("doc_id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in got)


def test_chunks_cover_the_text():
    for n in (0, 1, 7, 8, 9, 12, 13, 100):
        text = bytes(range(1, 101))[:n]
        rows = quality.chunks(text)
        assert set(text) <= set(rows.ravel().tolist()) and rows.shape[1] == quality.WIDTH
    assert b"".join(w[:toxicity.STEP] for w in toxicity.windows(b"Ab" * 500)) == b"ab" * 500


def vectors(spark, rows):
    return frame(spark, rows, "vec_id long, embedding array<float>")


def exact(rows, asks, k):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if asks(q):
            out[q] = [(i, s) for s, i in sorted((-float(good[q] @ good[i]), i) for i in good if i != q)[:k]]
    return out


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 60)
    monkeypatch.setattr(ann, "CANDIDATES", 50)
    monkeypatch.setattr(ann, "QUERIES", 4)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + rng.normal(0, 0.6, 16)).tolist()) for k in range(1500)]
    rows += [(k, rows[5][1]) for k in range(1500, 1900)]
    got = {}
    for r in ann.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    want = exact(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want)
    hits = []
    for q, found in got.items():
        assert [r["rank"] for r in found] == list(range(1, len(found) + 1)) and q not in {r["vec_id"] for r in found}
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hits.append(len({r["vec_id"] for r in found} & {i for i, _ in want[q]}) / len(want[q]))
    assert np.mean(hits) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (20, [inf, 1.0]), (6, [0.5, 0.5]), (40, [-1.0, 0.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (7, [1.0, 2.0, 3.0])]
    frame_ = vectors(spark, rows).selectExpr("*", "1 AS part", "2 AS score")
    got = [tuple(r) for r in ann.nearest(frame_, F.col("vec_id") % 20 == 0, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 6, 0.5), (0, 3, 40, -1.0), (40, 1, 1, -0.5), (40, 2, 6, -0.5), (40, 3, 0, -1.0)]
    assert ann.nearest(frame_.filter("false"), F.lit(True)).collect() == []
