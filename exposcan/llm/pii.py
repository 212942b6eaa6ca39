"""Personal data in texts: what fixed patterns find, and what a skip-chain conditional random field adds.

Tokens are what stands between blanks; those without a digit or ``@`` cannot be personal data here and are
fixed as ordinary. The others are the nodes of a graph per document:

* *nodes* carry weights of their shape (digits, dots, signs, checksum, what stands beside them),
* *chain links* join neighbouring tokens, with a weight for each pair of labels,
* *skip links* join tokens far apart that are equal or alike: the same text, the same digits in another notation, a number with
  and without its prefix, an address with and without its domain. Ends of a skip link share a potential for having the same
  kind. Each token is linked to the next one of a key only, so links are in proportion to tokens.

What the patterns find is evidence: these tokens keep their kind, and loopy message passing carries it to the tokens
they are linked with, until the messages settle. A token whose kind is likely enough, and found somewhere along its skip links,
becomes a span together with neighbours of its kind.

Weights are fitted by pseudo-likelihood on a bounded sample, where the labels are those of the patterns. Tokens linked to a found one without being found themselves
teach nothing: they may be what the patterns miss. Weights of skip links start from a prior, as few documents repeat what they hold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents the weights are fitted on, and most bytes of each.
SAMPLE = 1_500
MOST_BYTES = 8_000
#: Least probability of a span that is added.
LIKELY = 0.8
#: Fewest digits of an added span, by kind; addresses need none.
DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 7}
#: Log-odds by which tokens with equal and with like keys favour one kind, before anything is learnt.
AGREE = (4.0, 3.0)
#: Most rounds of messages, and the change at which they have settled.
ROUNDS = 50
SETTLED = 1e-4

# --- fixed patterns -----------------------------------------------------------------------
# Runs are possessive and start only where a run starts, so hostile texts take linear time.

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NO_DIGIT = re.compile(r"[^0-9]+")
#: Signs that may stand around a token without being part of it.
_LEFT, _RIGHT = "\"'`*_#$%&|,.;:!?<>[]{})=~-/\\", "\"'`*_#$%&|,.;:!?<>[]{}(=~-/\\+@"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all matches of the fixed patterns that hold, by start and kind."""
    found, bound = [], 0
    while (sign := text.find("@", bound)) >= 0:
        start = bound + len(text[bound:sign].rstrip(LOCAL))
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            found.append((start, domain.end(), 0))
        bound = domain.end() if domain else sign + 1
    for m in _IP.finditer(text):
        # Longer parts are above 255 unless they begin with zeros.
        if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m.groups()):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


# --- graph of a document ------------------------------------------------------------------

LABELS = 1 + len(KINDS)  # 0 is ordinary
FEATURES = 34


@dataclass
class Graph:
    """Tokens that may be personal data, in order."""

    number: list[int] = field(default_factory=list)  # among all tokens
    span: list[tuple[int, int]] = field(default_factory=list)
    digits: list[str] = field(default_factory=list)
    shape: list[list[int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)  # found by a pattern, else 0
    open: list[list[bool]] = field(default_factory=list)  # labels it may take
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: dict[tuple[int, int], int] = field(default_factory=dict)  # pair: 0 equal, 1 alike


def _shape(core: str, digits: str) -> list[int]:
    """Numbers of the features that hold."""
    n = len(digits)
    groups = re.split(r"[^0-9]+", core.strip("()+"))
    letters = any(c.isalpha() for c in core)
    dots = core.count(".")
    held = [0, 1 + next(k for k, most in enumerate((0, 1, 2, 3, 4, 6, 7, 8, 11, 15, 16, 19, 1 << 60)) if n <= most)]
    tests = (
        "@" in core[1:-1], letters, n > 0 and not letters and core.isdigit(), core[:1] == "+", core[:1] == "(", core[-1:] == ")", "-" in core[1:-1],
        dots == 3 and len(groups) == 4, dots == 3 and len(groups) == 4 and all(g and len(g) < 4 and int(g) <= 255 for g in groups), dots > 0,
        12 <= n <= 19 and not letters and luhn(digits), len(groups) == 2 and [len(g) for g in groups] == [3, 4], 9 <= n <= 15 and core[:1] == "+",
    )
    return held + [14 + k for k, holds in enumerate(tests) if holds]


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph:
    g = Graph()
    at, number, ends = 0, -1, [b[:2] for b in base]
    longest = max((z - a for a, z in ends), default=0)
    for m in _TOKEN.finditer(text):
        number += 1
        token = m.group()
        core = token.lstrip(_LEFT)
        start = m.start() + len(token) - len(core)
        core = core.rstrip(_RIGHT)
        digits = _NO_DIGIT.sub("", core)
        if not core or not (digits or "@" in core):
            continue
        end = start + len(core)
        while at < len(base) and base[at][0] + longest <= start:
            at += 1
        label, k = 0, at
        while k < len(base) and base[k][0] < end:
            if base[k][1] > start and (label == 0 or base[k][2] + 1 < label):
                label = base[k][2] + 1
            k += 1
        letters = any(c.isalpha() for c in core)
        parts = [len(p) for p in re.split(r"[^0-9]+", core) if p]
        g.number.append(number)
        g.span.append((start, end))
        g.digits.append(digits)
        g.shape.append(_shape(core, digits))
        g.label.append(label)
        g.open.append([True, "@" in core or letters, len(parts) >= 4 and max(parts) <= 3 and "." in core and not letters, len(digits) >= 4 and not letters, (len(digits) >= 3 or core[:1] == "+") and not letters])
    _link(g, text)
    return g


def _link(g: Graph, text: str) -> None:
    """Chain links, features of the neighbours, and skip links from each token to the next one with an equal or like key."""
    n = len(g.number)
    keys: dict[tuple, int] = {}
    g.chain = [(i, i + 1) for i in range(n - 1) if g.number[i] + 1 == g.number[i + 1]]
    before, after = {j for _, j in g.chain}, {i for i, _ in g.chain}

    def link(key: tuple, kind: int, i: int) -> None:
        j = keys.get(key)
        keys[key] = i
        if j is not None and g.skip.get((j, i), 2) > kind:
            g.skip[j, i] = kind

    i = 0
    while i < n:
        # Numbers in several tokens: all of them go by the digits of the whole.
        last = i
        while last + 1 < n and last in after and not any(g.open[k][1] for k in (i, last + 1)) and last - i < 7:
            last += 1
        whole = "".join(g.digits[i:last + 1])
        for k in range(i, last + 1):
            core = text[slice(*g.span[k])].lower()
            if len(core) >= 5:
                link(("same", core), 0, k)
            if len(g.digits[k]) >= 7 and not g.open[k][1]:
                link(("tail", g.digits[k][-7:]), 1, k)
                if len(g.digits[k]) >= 10:
                    link(("head", g.digits[k][:10]), 1, k)
            if len(whole) >= 7:
                link(("whole", whole), 0, k)
            local = core.split("@")[0]
            if g.open[k][1] and len(local) >= 5:
                link(("local", local), 1, k)
            g.shape[k] += [27 + (k not in before), 29 + (k not in after), 31 + (last > i)]
            if core.count("@") == 1:
                g.shape[k].append(33)
        i = last + 1


# --- the field ----------------------------------------------------------------------------


@dataclass
class Field:
    """Weights of shapes, of neighbouring labels, and of equal labels at the ends of a skip link."""

    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def nodes(self, g: Graph) -> np.ndarray:
        scores = np.array([self.shape[:, held].sum(axis=1) for held in g.shape])
        scores[~np.array(g.open)] = -1e3
        for i, label in enumerate(g.label):
            if label:
                scores[i] = -1e6
                scores[i, label] = 0
        return scores

    def marginals(self, g: Graph) -> np.ndarray:
        """Probabilities of the labels of each token by loopy message passing; exact where links form no loop."""
        nodes = self.nodes(g)
        links = [(i, j, self.chain) for i, j in g.chain] + [(i, j, np.diag(self.skip[kind])) for (i, j), kind in g.skip.items()]
        if links:
            here = np.array([[i, j] for i, j, _ in links]).T.ravel()
            there = np.array([[j, i] for i, j, _ in links]).T.ravel()
            pairs = np.array([p for *_, p in links])
            pairs = np.concatenate([pairs, pairs.transpose(0, 2, 1)])  # by the label of `here`, then of `there`
            back = np.roll(np.arange(len(here)), len(links))
            messages = np.zeros((len(here), LABELS))
            for _ in range(ROUNDS):
                belief = nodes.copy()
                np.add.at(belief, there, messages)
                told = (belief[here] - messages[back])[:, :, None] + pairs
                top = told.max(axis=1)
                new = top + np.log(np.exp(told - top[:, None]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                change = np.abs(new - messages).max()
                messages = 0.5 * messages + 0.5 * new
                if change < SETTLED:
                    break
            np.add.at(nodes, there, messages)
        nodes = np.exp(nodes - nodes.max(axis=1, keepdims=True))
        return nodes / nodes.sum(axis=1, keepdims=True)


def blank_field() -> Field:
    """Nothing learnt: a token is ordinary unless it is found."""
    shape = np.zeros((LABELS, FEATURES))
    shape[0, 0] = 20.0
    skip = np.array([[0.0] + [a] * len(KINDS) for a in AGREE])
    return Field(shape, np.zeros((LABELS, LABELS)), skip)


def fit(texts: list[str], rounds: int = 200, rate: float = 0.1, ridge: float = 0.02) -> Field:
    """Weights of greatest pseudo-likelihood: each label given its neighbours', by gradient steps of adapted size."""
    held, labels, allowed, prev, next_, skips = [], [], [], [], [], []
    for text in texts:
        g = graph_of(text, base_spans(text))
        first, n = len(labels), len(g.number)
        doubtful = {k for pair in g.skip for k, o in (pair, pair[::-1]) if not g.label[k] and g.label[o]}
        held += g.shape
        labels += [-1 if k in doubtful else y for k, y in enumerate(g.label)]
        allowed += g.open
        before, after = [-1] * n, [-1] * n
        for i, j in g.chain:
            before[j], after[i] = i + first, j + first
        prev, next_ = prev + before, next_ + after
        skips += [(i + first, j + first, kind) for (i, j), kind in g.skip.items()]
    y = np.array(labels, int)
    field_ = blank_field()
    if not len(y) or not (y > 0).any():
        return field_
    x = np.zeros((len(y), FEATURES))
    for k, numbers in enumerate(held):
        x[k, numbers] = 1
    one = np.zeros((len(y) + 1, LABELS))  # the last row is for no neighbour, or one that teaches nothing
    one[np.flatnonzero(y >= 0), y[y >= 0]] = 1
    before, after = one[np.array(prev)], one[np.array(next_)]
    beside = np.zeros((len(AGREE), len(y), LABELS))
    for i, j, kind in skips:
        beside[kind, i] += one[j]
        beside[kind, j] += one[i]
    use = y >= 0
    # What a pattern finds need not be allowed by the shape of each of its tokens.
    blocked = np.where(np.array(allowed) | (one[:-1] > 0), 0.0, -1e3)
    weights = [np.zeros((LABELS, FEATURES)), np.zeros((LABELS, LABELS)), field_.skip.copy()]
    prior = [np.zeros_like(w) for w in weights[:2]] + [field_.skip]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        scores = x @ weights[0].T + before @ weights[1] + after @ weights[1].T + sum(b * w for b, w in zip(beside, weights[2])) + blocked
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - one[:-1])[use]
        slopes = [error.T @ x[use], before[use].T @ error + error.T @ after[use], np.array([(b[use] * error).sum(axis=0) for b in beside])]
        slopes[2][:, 0] = 0  # being ordinary is not shared
        for k, slope in enumerate(slopes):
            slope = slope / use.sum() + ridge / 100 * (weights[k] - prior[k])
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            weights[k] = weights[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return Field(*weights)


def _evidence(g: Graph) -> list[set[int]]:
    """For each token the kinds found among the tokens that skip links join it with, over any number of links."""
    root = list(range(len(g.number)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in g.skip:
        root[top(j)] = top(i)
    kinds: dict[int, set[int]] = {}
    for k, label in enumerate(g.label):
        kinds.setdefault(top(k), set()).update([label] if label else [])
    return [kinds[top(k)] for k in range(len(root))]


def added_spans(text: str, base: list[tuple[int, int, int]], model: Field) -> list[tuple[int, int, int]]:
    """Spans beyond ``base``: neighbouring tokens of one likely kind that overlap nothing found."""
    if not text or not base:
        # Without evidence no message says anything but what shapes say; these alone add nothing.
        return []
    g = graph_of(text, base)
    if all(g.label) or not g.number:
        return []
    p = model.marginals(g)
    linked = _evidence(g)
    best = np.where(np.array(g.label) > 0, 0, p.argmax(axis=1))
    likely = [int(best[k]) if best[k] and p[k, best[k]] >= LIKELY else 0 for k in range(len(best))]
    chained, out, k = set(g.chain), [], 0
    while k < len(likely):
        last = k
        while likely[k] and (last, last + 1) in chained and likely[last + 1] == likely[k]:
            last += 1
        kind = KINDS[likely[k] - 1] if likely[k] else None
        if kind and any(likely[k] in linked[i] for i in range(k, last + 1)) and sum(len(d) for d in g.digits[k:last + 1]) >= DIGITS[kind]:
            out.append((g.span[k][0], g.span[last][1], likely[k] - 1))
        k = last + 1
    return out


# --- Spark --------------------------------------------------------------------------------

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _detected(model: Field):
    def named(spans):
        return [{"kind": KINDS[k], "start": a, "end": z} for a, z, k in spans]

    def detect(batches):
        for batch in batches:
            base, every = [], []
            for value in batch.column("text"):
                text = (value.as_py() or b"").decode("utf-8", "replace")
                found = base_spans(text)
                base.append(named(found))
                every.append(named(sorted(found + added_spans(text, found, model), key=lambda s: (s[0], s[2], s[1]))))
            kind = pa.list_(_SPAN)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, kind), pa.array(every, kind)], names=["doc_id", "base", "spans"])

    return detect


def _may_hold(text: Column) -> Column:
    """Every pattern needs a digit but the first one, which needs its sign."""
    return text.rlike("[0-9@]")


def field_for(docs: DataFrame) -> Field:
    """The field fitted on up to ``SAMPLE`` documents that hold a digit or ``@``, in a fixed random order.

    Texts of over ``MOST_BYTES`` bytes teach nothing, so at most their product reaches the driver.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") <= MOST_BYTES) & _may_hold(F.col("text")))
    drawn = texts.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").cast("binary").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return fit([bytes(r["text"]).decode("utf-8", "replace") for r in rows])


def personal_data(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every row of ``docs`` (doc_id, text).

    Both are lists of (kind, start, end) in code points, end exclusive, by start and kind: what the fixed patterns find, and
    that together with what the field adds. Added spans overlap no base span.

    Null and empty texts hold nothing. Bytes that are not UTF-8 count as replacement characters. Each row is looked at by itself, so
    repeated rows and ids get a row each. Other columns are ignored.
    """
    model = model or field_for(docs)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(_may_hold(text), text).cast("binary").alias("text"))
    span = "array<struct<kind: string, start: long, end: long>>"
    return rows.mapInArrow(_detected(model), f"doc_id long, base {span}, spans {span}")
