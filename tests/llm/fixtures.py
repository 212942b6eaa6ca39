"""Hand-made documents, and plain Python versions of what the operators compute."""

import hashlib
import random
import re

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def docs(spark, texts, source="s"):
    """Documents of a list of texts, or of (id, text) pairs."""
    pairs = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    return frame(spark, [(i, t, "en", source, len(t or "")) for i, t in pairs])


def prose(rng, n, vocabulary=3000):
    return [f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n)]


def corpus(seed, n=120):
    """Texts with copies, near copies, shared passages and short texts."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    out = []
    for _ in range(n):
        kind, words = rng.random(), prose(rng, rng.choice([1, 3, 4, 5, 7, 12, 13, 14, 40, 150, 400]))
        if out and kind < 0.35:
            words = rng.choice(out).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(words) // 40, len(words) // 20])):
                if words:
                    words[rng.randrange(len(words))] = f"x{rng.random()}"
            if rng.random() < 0.3:
                words = words[rng.randrange(4):]
        elif kind < 0.6:
            at = rng.randrange(len(words) + 1)
            start = rng.randrange(40)
            words = words[:at] + passage[start:start + rng.choice([5, 13, 20, 60])] + words[at:]
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    return out


def shingle_set(text):
    words = BLANKS.findall(ascii_lower(text or ""))
    if not words:
        return set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or {tuple(words)}


def groups(pairs):
    """doc_id: (set size, smallest id reachable)."""
    sets, parent = {i: shingle_set(t) for i, t in pairs}, {i: i for i, _ in pairs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def cut_down(pairs, window=13):
    """doc_id: (words, words removed, digest of the rest, the rest)."""
    words, first = {i: BLANKS.findall(t or "") for i, t in pairs}, {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k:k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out
