"""Words of many texts are read once, and read as before."""

import random
import re
import unicodedata

import numpy as np

from depotline.llm import toxicity


def test_units_of_repeated_words_are_remembered(monkeypatch):
    seen = []
    one, many = toxicity.unit, toxicity._unit_of
    monkeypatch.setattr(toxicity, "unit", lambda w: seen.append(w) or one(w))
    monkeypatch.setattr(toxicity, "_unit_of", lambda words: seen.extend(words) or many(words))
    table = np.random.default_rng(1).standard_normal(toxicity.LETTERS ** 3).astype(np.float32)
    scorer = toxicity._Scorer(toxicity.Model(table, 0.0, np.zeros(4), 0.0, np.zeros(4)))
    marks = scorer.marks(["a b c is it so, not a d e f or: " * 3 + f"word{'ab'[i % 2]}" for i in range(50)])
    # A short word may be read for its score and for its letters.
    assert max(map(seen.count, seen)) <= 2 and len({tuple(m) for m in marks}) == 2


def test_units_are_read_letter_by_letter():
    def slow(word):
        word = word.lower()
        at = [i for i, c in enumerate(word) if c.isalpha()]
        inner = word[at[0]:at[-1] + 1] if at else ""
        inner = unicodedata.normalize("NFKC", inner.translate(toxicity.STANDS_FOR))
        return re.sub(r"(.)\1{2,}", r"\1\1", "".join(c for c in inner if c.isalpha()))

    rng = random.Random(3)
    for _ in range(20_000):
        word = "".join(rng.choice("abAB01$@!.é²ﬁ—ßİ3'\0") for _ in range(rng.randrange(9)))
        assert toxicity.unit(word) == slow(word) == toxicity._unit_of({word, "Aaaab"})[word]
    assert toxicity.joined_letters(["a", "b", "", "c", "d", "e", "xx", "f", "g", "h"]) == ["cde", "fgh"]
