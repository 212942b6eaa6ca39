import random

import pytest
from tokenizers import Tokenizer, models

from exposcan.llm.queries import PIECES
from exposcan.llm.token_counts import BLANK, Counter, read_pieces, token_counts
from tests.llm.fixtures import docs

PLAIN = [("<unk>", 0.0), ("<s>", 0.0), ("</s>", 0.0)]


def published(pieces, byte_fallback):
    return Tokenizer(models.Unigram(pieces, 0, byte_fallback))


def tokens(tokenizer, text):
    return len(tokenizer.encode(BLANK + text.replace(" ", BLANK), add_special_tokens=False).ids) if text else 0


def texts(seed, alphabet, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_public_vocabulary():
    pieces = read_pieces(PIECES)
    tokenizer, counter = published(pieces, True), Counter(pieces)
    samples = ["", " ", "   ", "Hello world", "über  allem", "日本語 text", "a😀😀b 𝒳", "tab\tand\nline", "x" * 3000, *texts(1, "aeinrst ehd.,\n", 200), *texts(2, "aé日😀Ω ")]
    assert counter.cut
    for text in samples:
        assert counter.count(text)[1] == tokens(tokenizer, text), text


@pytest.mark.parametrize("seed", range(4))
def test_ties(seed):
    """Equal scores everywhere, unknown characters, and pieces that reach over blanks."""
    rng = random.Random(seed)
    alphabet = "abc" + BLANK * (seed % 2)
    names = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))) for _ in range(25)})
    pieces = PLAIN + [(name, float(-rng.randrange(1, 4))) for name in names]
    tokenizer, counter = published(pieces, False), Counter(pieces)
    for text in texts(seed, "abcd  "):
        assert counter.count(text)[1] == tokens(tokenizer, text), text


def test_rows(spark):
    pieces = PLAIN + [(BLANK, -3.0), ("a", -1.0), ("ab", -1.5), (BLANK + "a", -1.0)]
    rows = [(1, None), (2, ""), (3, "ab ab"), (3, "ab ab"), (None, "a")]
    got = [tuple(r) for r in token_counts(docs(spark, rows).withColumnRenamed("source", "n_tokens"), pieces).collect()]
    # _a b: the b is unknown and costs -13; _ ab costs -4.5
    assert got == [(1, 0, 0, 0.0), (2, 0, 0, 0.0), (3, 5, 4, -9.0), (3, 5, 4, -9.0), (None, 1, 1, -1.0)]
