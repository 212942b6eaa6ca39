"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: one of ordinary text, and one of the same
size of ordinary text together with the byte strings that are typical of toxic documents.
A text is cut into overlapping windows, and each is compressed with either dictionary. Where the
toxic one saves bytes, the window holds something the ordinary text does not explain. The largest and the second
saving of a document, and how many windows save enough, give a calibrated probability.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exposcan.llm.labelled import fit_logistic, fold, labelled_sample, logistic, shift_to
from exposcan.llm.storage import fresh

#: Most training texts of each class, and most bytes of each.
PER_CLASS = 2_000
MOST_BYTES = 20_000
#: Bytes of a window, and from one window to the next.
WINDOW = 112
STEP = 96
#: Bytes of ordinary text and of typical strings in a dictionary.
ORDINARY = 40_000
TYPICAL = 300
#: Lengths of typical strings, and how many times more common than in ordinary text they must be.
LENGTHS = (5, 6, 7, 8)
RATIO = 40.0
#: Typical strings a toxic document should hold.
COVER = 3
#: Documents scoring this much are toxic.
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def windows(text: bytes) -> list[bytes]:
    """Windows over the whole text, lower-cased in A-Z; an empty text is one empty window."""
    text = text.lower()
    return [text[at:at + WINDOW] for at in range(0, max(1, len(text) - (WINDOW - STEP)), STEP)]


def _strings(word: bytes, among) -> set[bytes]:
    word = b" " + word + b" "
    return {s for n in LENGTHS for at in range(len(word) - n + 1) if (s := word[at:at + n]) in among}


def _common(texts: list[bytes], least: int) -> dict[bytes, int]:
    """Strings found in at least so many texts, and in how many.

    Length by length: a longer string can only be common if what it begins and ends with is. So few strings
    are held at a time.
    """
    found: dict[bytes, int] = {}
    shorter: dict[bytes, int] | None = None
    for n in LENGTHS:
        counts: Counter[bytes] = Counter()
        for text in texts:
            here = set()
            for word in set(text.lower().split()):
                word = b" " + word + b" "
                for at in range(len(word) - n + 1):
                    s = word[at:at + n]
                    if shorter is None or (s[:-1] in shorter and s[1:] in shorter):
                        here.add(s)
            counts.update(here)
        shorter = {s: k for s, k in counts.items() if k >= least}
        found |= shorter
    return found


def typical_strings(toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """Few strings, in far more toxic than ordinary documents, that most toxic documents hold.

    The next string is the one found in most toxic documents that have fewer than ``COVER`` of those taken;
    it is then lengthened by its neighbours as long as these come with it. The words it
    explains are set aside, and the search ends when a string adds too few documents.
    """
    least = max(3, len(toxic) // 50)
    common = _common(toxic, least)
    usual: Counter[bytes] = Counter()
    for text in ordinary:
        usual.update({s for w in set(text.lower().split()) for s in _strings(w, common)})
    weight = len(ordinary) / max(1, len(toxic))
    odds = {s: k * weight / (usual[s] + 0.5) for s, k in common.items()}
    odds = {s: o for s, o in odds.items() if o >= RATIO}
    words: dict[bytes, int] = {}  # word: documents, as bits
    of: dict[bytes, set[bytes]] = {}
    for k, text in enumerate(toxic):
        for w in set(text.lower().split()):
            if w not in of:
                of[w] = _strings(w, odds)
            if of[w]:
                words[w] = words.get(w, 0) | 1 << k

    def places() -> dict[bytes, int]:
        found: dict[bytes, int] = {}
        for w, at in words.items():
            for s in of[w]:
                found[s] = found.get(s, 0) | at
        return found

    taken: list[bytes] = []
    open_ = [(1 << len(toxic)) - 1] * COVER  # documents with no more than 0, 1, ... of the strings taken
    while sum(map(len, taken)) < TYPICAL and (now := places()):
        best = max(now, key=lambda s: (sum((now[s] & o).bit_count() for o in open_), odds[s], s))
        docs = now[best]
        if (docs & open_[-1]).bit_count() < least:
            break
        whole, longer = best, True
        while longer and len(whole) < 32:
            longer = False
            for s, there in now.items():
                if s not in whole and (there & docs).bit_count() >= 0.9 * max(there.bit_count(), docs.bit_count()):
                    if whole.endswith(s[:-1]):
                        whole, longer = whole + s[-1:], True
                    elif whole.startswith(s[1:]):
                        whole, longer = s[:1] + whole, True
        taken.append(whole)
        for k in range(COVER - 1, -1, -1):
            open_[k] &= ~docs | (open_[k - 1] if k else 0)
        words = {w: at for w, at in words.items() if best not in b" " + w + b" "}
    return b"".join(taken)


@dataclass
class ToxicityModel:
    typical: bytes
    ordinary: bytes
    enough: int
    mean: list[float]
    scale: list[float]
    weights: list[float]

    def compressors(self):
        settings = zstandard.ZstdCompressionParameters(
            window_log=16, hash_log=14, chain_log=15, search_log=5, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        made = []
        for content in (self.ordinary, self.typical + self.ordinary):
            # A dictionary holds eight bytes at least.
            words = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=settings)
            made.append(zstandard.ZstdCompressor(dict_data=words, compression_params=settings).compress)
        return made

    def features(self, text: bytes, ordinary, toxic) -> list[float]:
        saved = sorted((len(ordinary(w)) - len(toxic(w)) for w in windows(text)), reverse=True)
        return [saved[0], saved[1] if len(saved) > 1 else 0, float(np.log1p(sum(s >= self.enough for s in saved)))]

    def logit(self, features: list[float]) -> float:
        z = [(f - m) / s for f, m, s in zip(features, self.mean, self.scale)]
        return self.weights[0] + sum(w * v for w, v in zip(self.weights[1:], z))


def train_toxicity(sample: list[tuple[int, bytes]]) -> ToxicityModel:
    """Dictionaries from two thirds of the sample, calibration on the rest.

    Without a text of each class the score is 0 throughout.
    """
    made, held = [s for k, s in enumerate(sample) if k % 3], [s for k, s in enumerate(sample) if k % 3 == 0]
    toxic, usual = [t for y, t in made if y == 1], [t for y, t in made if y == 0]
    model = ToxicityModel(b"", b"", 3, [0.0] * 3, [1.0] * 3, [-30.0, 0.0, 0.0, 0.0])
    if not toxic or not usual or len({y for y, _ in held}) < 2:
        return model
    each = max(200, ORDINARY // len(usual) + 1)
    model.ordinary = b" ".join(t[:each] for t in usual).lower()[:ORDINARY]
    model.typical = typical_strings(toxic, usual)
    pair = model.compressors()
    x = np.array([model.features(t, *pair) for _, t in held], float)
    y = np.array([y for y, _ in held])
    mean, scale, weights = fit_logistic(x, y)
    model.mean, model.scale, model.weights = mean.tolist(), scale.tolist(), weights.tolist()
    model.weights[0] += shift_to(np.array([model.logit(f) for f in x.tolist()]), y, THRESHOLD, 0)
    return model


def _scored(model: ToxicityModel, schema: list[str], text: str = "_text", score: str = "_score"):
    def run(batches):
        pair = model.compressors()
        for batch in batches:
            scores = [logistic(model.logit(model.features(t.as_py() or b"", *pair))) for t in batch.column(text).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema), pa.array(scores, pa.float64())], names=[*schema, score])

    return run


def held_out(doc_id: Column) -> Column:
    """Rows no label is learnt from; a null id counts as not held out."""
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def model_for(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return train_toxicity(labelled_sample(docs, labels, "toxic", held_out(F.col("doc_id")), PER_CLASS, MOST_BYTES))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs`` (doc_id, text).

    Null and empty texts are one empty window. Each row is scored by itself, so repeated
    rows and ids get a row each. Label rows with nulls teach nothing. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    scored = rows.mapInArrow(_scored(model_for(docs, labels), ["doc_id"]), "doc_id long, _score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    text, score = fresh("_text", docs.columns), fresh("_score", docs.columns)
    rows = docs.withColumn(text, F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    return rows.mapInArrow(_scored(model_for(docs, labels), docs.columns, text, score), schema).filter(F.col(score) < THRESHOLD).select(*docs.columns)
