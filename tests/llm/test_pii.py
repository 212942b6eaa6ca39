"""Personal data: the fixed patterns against Python's ``re``, the field against sums over all labellings."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from exposcan.llm import pii
from exposcan.llm.queries import QUERIES
from tests.llm.fixtures import frame, prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checksum(digits):
    doubled = [int(d) for d in digits[::-1]]
    return (sum(doubled[::2]) + sum(sum(map(int, str(2 * d))) for d in doubled[1::2])) % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and checksum(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end()))
    return [(list(PLAIN)[order], a, z) for a, order, z in sorted(out)]


def named(spans):
    return [(pii.KINDS[k], a, z) for a, z, k in spans]


def card(rng, n=16):
    """A number with a right checksum."""
    digits = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(digits + d for d in "0123456789" if checksum(digits + d))


def personal(rng):
    number = card(rng)
    return [
        f"{rng.choice(['jo', 'mara.lind', 'x_y'])}.{rng.randrange(100):02d}@mail{rng.randrange(9)}.example.com",
        ".".join(str(rng.randrange(256)) for _ in range(4)), number, " ".join(number[k:k + 4] for k in range(0, 16, 4)),
        f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(10**4):04d}",
    ]


def test_patterns_on_random_texts():
    rng = random.Random(0)
    parts = ["@", ".", "-", "+", " ", "(", ")", "a", "Z", "_", "%", "é", "1", "25", "255", "256", "007", "0000000255", "1.2.3.4", "4111 1111 1111 1111", "4111-1111", "+49", "\n", "a@b", "x.y", "--", "  "]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        assert named(pii.base_spans(text)) == plain_spans(text), text
    for _ in range(300):
        text = " ".join(rng.choice([*personal(rng), *prose(rng, 3)]) for _ in range(20))
        assert named(pii.base_spans(text)) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "a@b." * 80_000, "+" * 200_000, "4 " * 150_000, "@" * 200_000, "x1" * 100_000])
def test_hostile_texts(text):
    base = pii.base_spans(text)
    pii.added_spans(text, base or [(0, 1, 0)], pii.blank_field())


def texts_to_learn(rng, n=300):
    out = []
    for _ in range(n):
        words = prose(rng, 30)
        for item in rng.sample(personal(rng), 2):
            for _ in range(rng.choice([1, 1, 2])):
                words.insert(rng.randrange(len(words)), item)
        words.insert(5, str(rng.randrange(10 ** rng.randrange(1, 12))))
        out.append(" ".join(words))
    return out


def test_messages_are_exact_on_trees_and_settle_on_loops():
    rng = random.Random(3)
    model = pii.fit(texts_to_learn(rng, 60))
    text = "a1b2 call 555-3729 or 12 34 +1 (799) 555-3729 now"
    g = pii.graph_of(text, [])
    nodes = model.nodes(g)
    assert 3 <= len(g.number) <= 7 and g.skip

    def sums(graph):
        total, mass = 0, np.zeros((len(graph.number), pii.LABELS))
        for ys in itertools.product(range(pii.LABELS), repeat=len(graph.number)):
            score = sum(nodes[k, y] for k, y in enumerate(ys)) + sum(model.chain[ys[i], ys[j]] for i, j in graph.chain)
            score += sum(model.skip[kind][ys[i]] * (ys[i] == ys[j]) for (i, j), kind in graph.skip.items())
            for k, y in enumerate(ys):
                mass[k, y] += np.exp(score)
            total += np.exp(score)
        return mass / total

    assert np.abs(model.marginals(g) - sums(g)).max() < 0.1
    g.skip = {}
    assert np.abs(model.marginals(g) - sums(g)).max() < 1e-3


def test_like_tokens_take_the_kind_of_what_is_found():
    rng = random.Random(1)
    model = pii.fit(texts_to_learn(rng))
    cases = {
        "call +1 (799) 555-3729 now, or w1 w2 (799) 555-3729 w3": ("phone", "(799) 555-3729"),
        "write mara.lind.07@mail3.example.com and then mara.lind.07@mail3 again": ("email", "mara.lind.07@mail3"),
        "paid with 4111 1111 1111 1111 today w2 w3 4111.1111.1111.1111 w4": ("card", "4111.1111.1111.1111"),
    }
    for text, (kind, held) in cases.items():
        base = pii.base_spans(text)
        added = pii.added_spans(text, base, model)
        assert [(pii.KINDS[k], text[a:z]) for a, z, k in added] == [(kind, held)], text
    for text in ("w1 w2 (799) 555-3729 w3", "call +1 (799) 555-3729 at 12 or 2021 w3 17 99999999", "jo.11@mail1.example.com w1 mail1 w2 v11 3.5", "9914969043960559 w 9914969043960558 and 9914969043960558 " + personal(rng)[0]):
        assert pii.added_spans(text, pii.base_spans(text), model) == [], text
    assert pii.added_spans("call +1 (799) 555-3729 or (799) 555-3729", [], pii.fit([])) == []


def test_query(spark, tmp_path):
    rng = random.Random(2)
    texts = texts_to_learn(rng, 150) + ["É +1 (799) 555-3729 ü (799) 555-3729", None, "", " ", "no data", "5", "@", " ".join(["1.2.3.4", "w"] * 20_000)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rows += [(None, "a.b@c.de", None, None, None), *rows[:4], (0, "another 1.2.3.4", "x", "y", 1)]
    frame(spark, rows).selectExpr("*", "1 as base", "2 as spans", "3 as kind").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_personal_data"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)

    def want(text):
        spans = plain_spans(text or "")
        listed = [f"{kind}:{a}:{z}" for kind, a, z in spans]
        return (*(sum(s[0] == kind for s in spans) for kind in PLAIN), hashlib.sha256(",".join(listed).encode()).hexdigest()), listed

    plain = sorted(((r[0], *want(r[1])[0]) for r in rows), key=str)
    assert sorted((tuple(r)[:6] for r in got), key=str) == plain
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(want(r[1])[1])
    for r in got:
        spans = r["spans"].split(",") if r["spans"] else []
        assert any(set(base) <= set(spans) for base in by_id[r["doc_id"]])
        assert len(set(spans)) == len(spans) and [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
    assert [r["spans"] for r in got if r["doc_id"] == 150] == ["phone:2:19,phone:22:36"]


def test_no_rows_and_odd_bytes(spark):
    assert pii.personal_data(frame(spark, [])).collect() == []
    odd = spark.sql("select 1L as doc_id, cast(concat(unhex('FF'), cast(' 1.2.3.4' as binary)) as string) as text")
    assert pii.personal_data(odd).first()["base"] == [("ip", 2, 9)]
