import random

import numpy as np
import pyarrow as pa
import pytest

from exposcan.llm import jaccard
from exposcan.llm.jaccard import bit_sketch, chunk_keys, filings, near_duplicate_groups, one_of_each, shingles
from tests.llm.fixtures import corpus, docs, groups, prose, shingle_set


def result(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    texts = corpus(seed)
    assert result(near_duplicate_groups(docs(spark, texts))) == groups(list(enumerate(texts)))


def test_large_group_of_near_copies(spark):
    """Copies of one text that are similar to it but not to each other."""
    rng = random.Random(4)
    base = prose(rng, 200)
    texts = [" ".join(base)]
    for k in range(60):
        words = list(base)
        for at in rng.sample(range(0, 200, 10), 4):
            words[at] = f"n{k}-{at}"
        texts.append(" ".join(words))
    rng.shuffle(texts)
    assert result(near_duplicate_groups(docs(spark, texts))) == groups(list(enumerate(texts)))


def unlike_copies(rng, n, changes=9, length=200):
    """Near copies of one text, no two of them similar."""
    base, out = prose(rng, length, 10**6), []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(length), changes):
            words[at] = f"n{k}-{at}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("n", [300, 600])
def test_second_pass_puts_out_fewer_rows_than_it_reads(n):
    rng = random.Random(n)
    sets = sorted((shingles(t.encode()) for t in unlike_copies(rng, n)), key=len)
    sizes = np.array([len(x) for x in sets])
    band = filings(int(sizes[0]))[0][0]
    first = {"rep": range(n), "n_shingles": sizes, "component": range(n), "part": [k % 2 for k in range(n)]}
    for low, high in ((0, 0), (0, 1)):
        blocks = {"low": [low] * n, "high": [high] * n}
        sketched = pa.table({"key": [1] * n, **first, **blocks, "sketch": [bit_sketch(x, band).tobytes() for x in sets]})
        likely = sum(b.num_rows for b in jaccard._compared(iter(sketched.to_batches(max_chunksize=97))))
        assert likely < n
        held = pa.table({"group": [1] * n, "doc": range(n), **first, **blocks, "tokens": [x.view(np.int64) for x in sets]})
        assert sum(b.num_rows for b in jaccard._linked(iter(held.to_batches(max_chunksize=97)))) == 0
        # The same with one text that all are similar to: it joins them.
        alike = [*sets[:-1], np.unique(np.concatenate(sets[:1]))]
        held = held.set_column(held.schema.get_field_index("tokens"), "tokens", pa.array([x.view(np.int64) for x in alike], pa.list_(pa.int64())))
        assert sum(b.num_rows for b in jaccard._linked(iter(held.to_batches()))) <= 1


def test_unlike_copies_and_their_original(spark):
    """Only the original joins the copies, and its id is the largest; some copies are joined by others only."""
    rng = random.Random(12)
    texts = unlike_copies(rng, 120, 8)
    close = [t + " more words at the end" for t in texts[:40]]
    texts = [*texts, *close]
    rng.shuffle(texts)
    assert result(near_duplicate_groups(docs(spark, texts))) == groups(list(enumerate(texts)))


def test_groups_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "GROUP_BYTES", 20_000)
    rng = random.Random(13)
    texts = unlike_copies(rng, 60, 6) + unlike_copies(rng, 60, 7)
    rng.shuffle(texts)
    assert result(near_duplicate_groups(docs(spark, texts))) == groups(list(enumerate(texts)))


def test_other_columns_keep_their_names(spark):
    frame = docs(spark, ["a b c d e f", "a b c d e f", "g"]).selectExpr("*", "doc_id + 10 as _id", "7 as _ID_", "8 as component_id")
    assert [(r["doc_id"], r["_id"], r["_ID_"]) for r in one_of_each(frame).orderBy("doc_id").collect()] == [(0, 10, 7), (2, 12, 7)]


def test_edges(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One two"), (9, "one  TWO"), (10, "É a b c d e"), (11, "é a b c d e"), (12, "w " * 50_000), (13, "w " * 40_000), (None, "one two"), (9, "one two")]
    got = sorted(near_duplicate_groups(docs(spark, rows)).collect(), key=str)
    want = [(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (9, 1, 8), (10, 2, 10), (11, 2, 11), (12, 1, 12), (13, 1, 12), (None, 1, None)]
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: str(tuple(r)).replace("(", "")) or sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty = near_duplicate_groups(docs(spark, [(1, "a")]).filter("doc_id = 2"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id"]


def several(rows):
    """doc_id: smallest id reachable, where an id may have several texts."""
    texts = groups([(k, text) for k, (_, text) in enumerate(rows)])
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (_, first) in texts.items():
        x, y = root(rows[k][0]), root(rows[first][0])
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_several_texts_under_one_id(spark):
    rng, rows = random.Random(7), []
    for k in range(40):
        x, y = prose(rng, 110), prose(rng, 100)
        near = [list(x), list(y)]
        for words in near:
            words[rng.randrange(len(words))] = "new"
        rows += [(3 * k, x), (3 * k, y), (3 * k + 1, near[0]), (3 * k + 2, near[1])]
    rows = [(i, " ".join(words)) for i, words in rows] + [(500, ""), (500, "a b c d e f"), (501, "a b c d e f"), (501, None)]
    rng.shuffle(rows)
    got = near_duplicate_groups(docs(spark, rows)).collect()
    assert len(got) == len(rows) and {(r["doc_id"], r["component_id"]) for r in got} == set(several(rows).items())


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(100), text) for text in corpus(seed)]
    got = near_duplicate_groups(docs(spark, rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(several(rows).items())


def test_keeps_the_smallest_of_a_group(spark):
    frame = docs(spark, ["a b c d e f", "A b c d e f", "g h i", ""]).withColumnRenamed("source", "key")
    kept = one_of_each(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]


def test_similar_sets_share_a_key():
    """The pigeonhole argument, at the edge of similarity and for every size."""
    rng = np.random.default_rng(1)
    for n in [*range(1, 60), 100, 127, 128, 129, 255, 256, 300, 511, 512, 640, 1000]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for grown in {0, n // 8, n // 4}:
            for lost in range(0, n // 9 + 1, max(1, n // 30)):
                b = np.unique(np.concatenate([a[lost:], rng.integers(0, 1 << 63, grown, dtype=np.uint64)]))
                both = len(a) - lost
                if lost + grown and 100 * both >= 80 * (len(a) + len(b) - both):
                    keys = [{int(k) for band, bound in filings(len(s)) for level in chunk_keys(s, band, bound) for k in level} for s in (a, b)]
                    assert keys[0] & keys[1], (n, lost, grown)
                    band = (set(x for x, _ in filings(len(a))) & set(x for x, _ in filings(len(b)))).pop()
                    distance = np.bitwise_count(bit_sketch(a, band) ^ bit_sketch(b, band)).sum()
                    assert distance <= lost + grown


def test_shingles_are_those_of_the_words():
    for text in corpus(3, 40):
        assert len(shingles(text.encode())) == len(shingle_set(text))
