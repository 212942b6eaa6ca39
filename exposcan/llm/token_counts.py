"""Token counts under a unigram vocabulary, without building the tokens.

Count-only Viterbi: an Aho-Corasick automaton lists every vocabulary piece that ends at a
place, and dynamic programming carries the best score and the number of pieces to that place. Ties follow the published
unigram tokenizer: places are extended in order of their start and a later path must be
better, so of equal paths the one whose last piece starts first stays. A character that no one-character piece
covers costs the least score less 10 as an unknown; unknown characters next to each other are one unknown, which
counts as its bytes if the vocabulary has byte pieces, else as one.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What the tokenizer writes for a blank.
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task remembers.
REMEMBERED = 400_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, in order of their ids; the first three are special."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class Counter:
    """Best score and number of tokens of a text, word by word where no piece reaches from one into the next."""

    def __init__(self, pieces: list[tuple[str, float]], special: int = 3):
        ordinary = [(p, s) for p, s in pieces[special:] if not (len(p) == 6 and p.startswith("<0x"))]
        self.bytes = any(len(p) == 6 and p.startswith("<0x") for p, _ in pieces)
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in ordinary:
            if piece and piece not in self.automaton:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        # Cutting before a blank is exact if no piece holds a blank after another character and a blank is
        # never unknown.
        self.cut = BLANK in self.automaton and all(BLANK not in p.lstrip(BLANK) for p, _ in ordinary)
        self.known: dict[str, tuple[float, int]] = {}

    def part(self, text: str) -> tuple[float, int]:
        """Score and tokens of a piece of text, by dynamic programming over its characters."""
        n = len(text)
        # Score, tokens but for an unknown at the end, characters and bytes of that unknown.
        best: list = [None] * (n + 1)
        best[0] = (0.0, 0, 0, 0)
        ends: list[list] = [[] for _ in range(n + 1)]
        if len(self.automaton):
            for end, (length, score) in self.automaton.iter(text):
                ends[end + 1].append((length, score))
        for at in range(1, n + 1):
            found, single = None, False
            for length, score in ends[at]:  # the longest, which starts first, comes first
                single |= length == 1
                before = best[at - length]
                total = before[0] + score
                if found is None or total > found[0]:
                    found = total, before, False
            if not single:
                before = best[at - 1]
                total = before[0] + self.unknown
                if found is None or total > found[0]:
                    found = total, before, True
            total, before, unknown = found
            if unknown:
                best[at] = (total, before[1], before[2] + 1, before[3] + len(text[at - 1].encode()))
            else:
                best[at] = (total, before[1] + self._closed(before) + 1, 0, 0)
        end = best[n]
        return end[0], end[1] + self._closed(end)

    def _closed(self, state) -> int:
        return 0 if not state[2] else state[3] if self.bytes else 1

    def count(self, text: str) -> tuple[float, int]:
        """Score and number of tokens of a text; a blank is put before it unless it is empty."""
        if not text:
            return 0.0, 0
        text = BLANK + text.replace(" ", BLANK)
        if not self.cut:
            return self.part(text)
        score, tokens, blanks = 0.0, 0, ""
        for word in text[1:].split(BLANK):
            blanks += BLANK
            if word:
                key = blanks + word
                found = self.known.get(key)
                if found is None:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    found = self.known[key] = self.part(key)
                score, tokens, blanks = score + found[0], tokens + found[1], ""
        if blanks:
            found = self.part(blanks)
            score, tokens = score + found[0], tokens + found[1]
        return score, tokens


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], special: int = 3) -> DataFrame:
    """``doc_id``, ``n_chars``, ``n_tokens`` and ``score`` of the whole text of every row of ``docs`` (doc_id, text).

    ``pieces`` are vocabulary pieces and scores, the first ``special`` of them not for text. A null or empty text
    has no tokens and score 0. Each row is counted by itself; other columns are ignored.
    The vocabulary goes to every task with the function: some 32,000 short strings.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        counter = Counter(shared.value, special)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            found = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[0] for f in found], pa.float64())],
                names=["doc_id", "n_chars", "n_tokens", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_tokens long, score double")
