import hashlib
import random

import pytest

from exposcan.llm import repeats
from tests.llm.fixtures import BLANKS, corpus, cut_down, docs, prose


@pytest.mark.parametrize(("seed", "bucket"), [(1, 400_000), (2, 2_000)])
def test_brute_force(spark, monkeypatch, seed, bucket):
    monkeypatch.setattr(repeats, "BUCKET_WORDS", bucket)
    monkeypatch.setattr(repeats, "SHARD", 50)
    texts = corpus(seed)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.repeated_words(docs(spark, texts)).collect()}
    assert got == {i: v[:3] for i, v in cut_down(list(enumerate(texts))).items()}


def test_edges(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    same = "the same thirteen words " * 12
    rows = [(1, None), (2, ""), (3, long), (4, "x " + long + " y"), (5, same), (6, same), (6, same), (None, same)]
    got = sorted(map(tuple, repeats.repeated_words(docs(spark, rows)).collect()), key=str)
    want = cut_down([r for r in rows if r[0] is not None])
    whole = cut_down([(0, same)])[0]
    assert got == sorted([*((i, *want[i][:3]) for i, _ in rows if i is not None), (None, *whole[:3])], key=str)
    assert want[4][1] == 30_000 and repeats.repeated_words(docs(spark, rows).filter("doc_id = 99")).collect() == []


def cut_rows(rows, window=13):
    """(id, words, words removed, digest of the rest) of every row, where an id may have several texts."""
    first = {}
    for i, text in rows:
        words = BLANKS.findall(text or "")
        for k in range(len(words) - window + 1):
            first[tuple(words[k:k + window])] = min(i, first.get(tuple(words[k:k + window]), i))
    out = []
    for i, text in rows:
        words, gone = BLANKS.findall(text or ""), set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()))
    return sorted(out)


def test_copy_and_another_text_under_one_id(spark):
    x, y, z = (prose(random.Random(k), 120) for k in (1, 2, 3))
    rows = [(3, x), (5, x), (5, y), (8, [*"abc", *y[20:80], *"def"]), (9, [*z[:30], *y[:40]]), (9, "too short".split()), (9, []), (10, z[:30] + y[:40]), (11, y[:40] + x[:50]), (11, x[:50])]
    rows = [(i, " ".join(words)) for i, words in rows]
    got = sorted(map(tuple, repeats.repeated_words(docs(spark, rows)).collect()))
    assert got == cut_rows(rows) and got[-4][2] == 40


def test_several_texts_at_the_same_places(spark):
    x, y = (prose(random.Random(k), 200) for k in (4, 5))
    rows = [(1, x), (1, y), (2, ["q", *x[:70]]), (2, ["r", *y[:60]]), (3, x[100:] + y[100:]), (4, x[:90]), (4, x[:90] + y[:20]), (5, x[:90]), (6, x[:90] + y[:20])]
    rows = [(i, " ".join(words)) for i, words in rows]
    assert sorted(map(tuple, repeats.repeated_words(docs(spark, rows)).collect())) == cut_rows(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(40), text) for text in corpus(seed)]
    got = sorted(map(tuple, repeats.repeated_words(docs(spark, rows)).collect()))
    assert got == cut_rows(rows)


def test_texts(spark):
    texts = ["a\nb", *corpus(5, 40)]
    frame = docs(spark, texts).withColumnRenamed("lang", "words")
    got = {r["doc_id"]: r for r in repeats.without_repeats(frame).collect()}
    for i, (n, gone, _, kept) in cut_down(list(enumerate(texts))).items():
        if gone and not kept:
            assert i not in got
        else:
            assert got[i]["text"] == (kept if gone else texts[i]) and got[i]["n_chars"] == len(got[i]["text"])
    assert repeats.without_repeats(frame).columns == frame.columns
