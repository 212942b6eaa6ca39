"""Licence scan, url filter, decontamination and mixing: no Python in their plans, and plain versions."""

import random
import re

import pytest

from exposcan.llm import decontaminate, licenses, mixing, storage, urls
from tests.llm.fixtures import ascii_lower, docs, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


@pytest.fixture
def plain_frames(spark):
    some = docs(spark, ["a b c d e f g h", "under the MIT License"])
    bench = frame(spark, [(1, "a b c d e f g h i")], "item_id long, text string")
    pages = frame(spark, [(1, "http://a.org/")], "page_id long, url string")
    return [licenses.license_scan(some), urls.filter_urls(pages, urls.rule_table(spark)), decontaminate.leaks(some, bench), mixing.mixture(some)]


def test_no_python_in_the_plans(plain_frames):
    for f in plain_frames:
        assert not re.search("Python|Pandas|Arrow", plan_of(f))


# --- licences ---------------------------------------------------------------------------


def base_of(text):
    words = WORD.findall(ascii_lower(text or ""))
    found = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({v for _, v in found})))


def test_base_phrases(spark):
    rng = random.Random(2)
    parts = [*licenses.BASE, "Under THE mit-license", "Apache License, Version 2.0.", "CC BY-NC 4.0", "under the", "mİt license", "cc by n\u212A", "É", "", "x" * 50, "\n", "license version 2", "by nc cc by nc by nc"]
    texts = [None, "", *(rng.choice([" ", ". ", "-"]).join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(80)), "cc by nc " * 5_000]
    got = {r["doc_id"]: r for r in licenses.license_scan(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_of(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])


def test_wordings_with_changes(spark):
    mit = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files".split()
    changed = [*mit[:8], "whatsoever", *mit[8:14], *mit[15:]]
    texts = [" ".join(prose(random.Random(1), 50) + changed), " ".join(mit[:6]), " ".join(w for x in mit for w in (x, "and", "then"))]
    got = {r["doc_id"]: r for r in licenses.license_scan(docs(spark, texts)).collect()}
    assert got[0]["labels"] == "mit" and 0.6 <= got[0]["score"] < 1 and got[0]["n_base"] == 0
    assert got[1]["labels"] == "" and got[1]["score"] == 0 and got[2]["labels"] == ""


def test_near_wordings(spark):
    cc, gnu = "This work is licensed under a Creative Commons Attribution", "This work is licensed under the GNU"
    program = "is free software you can redistribute it and or modify it under the terms of the GNU"
    want = [
        *((phrase, label) for phrase, label in licenses.WORDINGS.items() if label != "apache-2"),
        (f"{cc} 4.0 License", ""), (f"{cc}-NoDerivatives 4.0", ""), (f"{cc}-ShareAlike 4.0", "cc-by-sa"), (f"{cc}-NonCommercial 4.0", "cc-by-nc"),
        (f"{gnu} General Public License version 2", ""), (f"{gnu} General Public License, version 3", "gpl-3"), (f"{gnu} Lesser General Public License version 3", ""),
        (f"This program {program} General Public License", "gpl"), (f"This program {program} Affero General Public License", ""), (f"This library {program} Lesser General Public License", ""),
        ("This work, too, is licensed under a Creative Commons Attribution-ShareAlike", "cc-by-sa"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_scan(docs(spark, [text for text, _ in want])).collect()}
    assert [got[k]["labels"] for k in range(len(want))] == [label for _, label in want]
    assert all(bool(got[k]["score"]) == bool(label) for k, (_, label) in enumerate(want))


def test_license_rows(spark):
    rows = [(1, "cc by nc"), (1, "cc by nc"), (1, "other"), (None, "cc by nc")]
    frame_ = docs(spark, rows).withColumnRenamed("lang", "labels").withColumnRenamed("source", "words")
    got = sorted((str(r["doc_id"]), r["n_base"], r["labels"]) for r in licenses.license_scan(frame_).collect())
    assert got == [("1", 0, ""), ("1", 1, "cc-by-nc"), ("1", 1, "cc-by-nc"), ("None", 1, "cc-by-nc")]
    assert licenses.license_scan(frame_.filter("doc_id = 7")).collect() == []


# --- urls -------------------------------------------------------------------------------


def judged(url, rules=urls.RULES):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (ascii_lower(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("few", [True, False])
def test_urls(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    rng = random.Random(3)
    hosts = ["org", "example.org", "A.Example.ORG", "xexample.org", "example.org:80", "com", "a.b.com", ".org", "org.", "", "a..com", "u@example.org", "www.example.com.", "a." * 300 + "com"]
    paths = ["", "/", "/es/", "/es", "/ES/x", "/en/1", "/en/10?x=/es/", "/en/2#a", "/fr/", "/de/q/r", "/fr", "//", "/de/" + "x" * 5000, "/é\n/"]
    tails = ["", "?a=http://x.org/", "#/de/", "://com/de/"]
    found = [None, "", "no scheme.org/", "://", "://org", "http://org/", "x://y://org/", *(f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(300))]
    rules = [*urls.RULES, ("block", "a.b.com", "/fr/"), ("allow", "", "/de/q"), ("allow", "com", "/de/")]
    pages = frame(spark, [*enumerate(found), (0, None), (5, found[5]), (None, "http://a.org/")], "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS key")
    got = sorted((tuple(r) for r in urls.filter_urls(pages, urls.rule_table(spark, rules)).collect()), key=str)
    want = [(i, *judged(u, rules)) for i, u in [*enumerate(found), (0, None), (5, found[5]), (None, "http://a.org/")]]
    assert got == sorted(want, key=str)


def test_urls_that_differ_in_the_query_only(spark):
    rows = [(i, u) for i in (None, 4) for u in ("http://a.org/x?q=1", "http://a.org/x?q=2", "http://a.org/x#q", "http://a.org/y", "none", None, "")]
    got = [tuple(r) for r in urls.filter_urls(frame(spark, rows, "page_id long, url string"), urls.rule_table(spark)).collect()]
    assert sorted(got, key=str) == sorted([(i, *judged(u)) for i, u in rows], key=str)


def test_no_rules_or_pages(spark):
    pages = frame(spark, [(1, "http://a.org/x")], "page_id long, url string")
    none = urls.rule_table(spark).filter("false")
    assert [tuple(r) for r in urls.filter_urls(pages, none).collect()] == [(1, "a.org", "/x", None, "allow")]
    assert urls.filter_urls(pages.filter("false"), urls.rule_table(spark)).collect() == []


# --- decontamination --------------------------------------------------------------------


def test_leaks(spark, monkeypatch):
    rng = random.Random(6)
    items = [" ".join(prose(rng, n)) for n in (40, 30, 13, 9, 7, 60)] + [None, ""]
    clean = [" ".join(prose(rng, 300)) for _ in range(30)]

    def planted(item, change):
        words = items[item].split()
        for k in range(2, len(words), change):
            words[k] = f"new{k}"
        around = prose(rng, 40)
        return " ".join(around[:20]).upper() + ".  " + ", ".join(words) + "\n" + " ".join(around[20:])

    texts = [*clean, planted(0, 1000), planted(1, 7), planted(5, 6), planted(2, 1000), planted(3, 1000), planted(4, 1000), items[0][len(items[0]) // 2:], None, "", planted(0, 2)]
    bench = frame(spark, [*enumerate(items), (None, items[0])], "item_id long, text string").selectExpr("*", "0 AS words", "'x' AS hash")
    want = {(30, 0), (31, 1), (32, 5), (33, 2), (34, 3), (36, 0)}
    for seeds in (decontaminate.SEEDS, 40):
        monkeypatch.setattr(decontaminate, "SEEDS", seeds)
        got = decontaminate.leaks(docs(spark, [*enumerate(texts), (30, texts[30]), (None, texts[30])]), bench).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    for r in got:
        item, text = (WORD.findall(ascii_lower(t)) for t in (items[r["item_id"]], texts[r["doc_id"]]))
        window = text[r["first_word"]:r["first_word"] + r["n_window"]]
        assert max(sum(a == b for a, b in zip(window, item[k:])) for k in range(len(item))) >= r["n_equal"] >= 0.8 * r["n_window"]
    kept = decontaminate.without_leaks(docs(spark, texts), bench)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert decontaminate.leaks(docs(spark, texts), bench.filter("false")).collect() == []
    assert decontaminate.leaks(docs(spark, texts).filter("false"), bench).collect() == []


def test_seeds_without_words_and_once_per_wording(spark, monkeypatch):
    """What goes to every task does not grow with the ids a wording has, nor with words per seed; blocks are written one by one."""
    rng = random.Random(16)
    first, second = (" ".join(prose(rng, 40)) for _ in range(2))
    tables = []

    def kept(frame_, label, **how):
        tables.append((label, frame_ := storage.settle(frame_, label, **how)))
        return frame_

    monkeypatch.setattr(decontaminate, "settle", kept)
    texts = docs(spark, [first, second, f"{first} and {second}"])
    for seeds, n_pairs in ((decontaminate.SEEDS, 0), (120, 2)):
        monkeypatch.setattr(decontaminate, "SEEDS", seeds)
        tables.clear()
        # One id has both wordings.
        bench = frame(spark, [*((k, first) for k in range(20)), (20, second), (20, first), (20, second)], "item_id long, text string")
        got = decontaminate.leaks(texts, bench).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted([*((d, k) for d in (0, 2) for k in range(21)), (1, 20)])
        by_label = {label: t for label, t in tables}
        assert set(by_label["seeds"].columns) == {"wording", "place", "hash"} and by_label["seeds"].count() == 2 * (40 - decontaminate.SPAN + 1) * len(decontaminate.MASKS)
        assert sum(label == "pairs" for label, _ in tables) == n_pairs


# --- mixing -----------------------------------------------------------------------------


def mix_docs(spark, n=600):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        source, lang = rng.choices(["hot", "b", "c", None], [60, 20, 15, 5])[0], rng.choice(["en", "en", "de", None])
        text = " ".join(prose(rng, rng.randrange(1, 80))) + rng.choice(["", "", " a@b", " | x", " License"])
        rows.append((k, text, lang, source, 0))
    return rows, frame(spark, [*rows, (n, None, "en", "hot", 0), (n + 1, "", "en", "hot", 0)])


def test_margins_and_probabilities(spark):
    rows, frame_ = mix_docs(spark)
    got = mixing.mixture(frame_).collect()
    assert len(got) == len(rows) + 2 and sum(r["kept"] for r in got if not r["n_tokens"]) == 0
    total = sum(r["n_tokens"] for r in got)
    cells = {(r["source"], r["lang"], r["topic"]): r["cell_weight"] for r in got if r["n_tokens"]}
    for at, name in enumerate(["source", "lang", "topic"]):
        tokens = {}
        for r in got:
            tokens[r[name]] = tokens.get(r[name], 0) + r["n_tokens"]
        goal = {k: v ** mixing.POWERS[name] for k, v in tokens.items()}
        for value, wanted in goal.items():
            assert sum(w for c, w in cells.items() if c[at] == value) == pytest.approx(wanted / sum(goal.values()), abs=2e-3)
    expected = sum(r["n_tokens"] * r["probability"] for r in got)
    assert expected == pytest.approx(mixing.KEPT * total, rel=0.02) and all(0 <= r["probability"] <= 1 for r in got)
    assert sum(r["n_tokens"] for r in got if r["kept"]) == pytest.approx(expected, rel=0.15)
    kept = mixing.mixed(frame_.withColumnRenamed("n_chars", "weight"))
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]} and kept.columns[-1] == "weight"


def test_empty_and_repeated(spark):
    rows, frame_ = mix_docs(spark, 40)
    assert mixing.mixture(frame_.filter("false")).collect() == [] and mixing.mixed(frame_.filter("doc_id >= 40")).collect() == []
    twice = mixing.mixture(frame_.union(frame_)).collect()
    kept = {}
    for r in twice:
        kept.setdefault(r["doc_id"], []).append(r["kept"])
    assert all(len(v) == 2 and v[0] == v[1] for v in kept.values())
    assert mixing.mixture(frame(spark, [(None, "a b", None, None, 0)])).collect()[0]["n_tokens"] == 2


# --- storage ----------------------------------------------------------------------------


def test_settling_gives_native_memory_back(spark, monkeypatch):
    said, trim = [], storage._trim
    monkeypatch.setattr(storage, "_trim", lambda session: said.append(trim(session)))
    assert storage.settle(spark.range(3), "three").count() == 3
    assert len(said) == 1 and (said[0] is None or said[0].startswith("Trim"))
    assert storage.settle(spark.range(3), "three", free=False).count() == 3 and len(said) == 1
