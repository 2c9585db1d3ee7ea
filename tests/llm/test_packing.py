"""Pieces against the vocabulary's own tokenizer, packing against its rules and bounds."""

import itertools
import random
from zlib import crc32

import numpy as np

from depotline.llm import packing


def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def _hostile(seed, n):
    rng = random.Random(seed)
    signs = list("ab'st 've  \n\t\r\x0b\x1c\x1d\x85\xa0é×÷ßЖжａ中文１２²½٣12_-—.,!<|>​ 　́́🙂᠎﻿")
    words = ["don't", "we'll", "it's", "Straße", "l'été", "<|endoftext|>", "  ", "\n\n", "aЖ", "x1", "1x", "a_b", "naïve"]
    return ["".join(rng.choice(words if rng.random() < 0.2 else signs) for _ in range(rng.randrange(60)))
            for _ in range(n)]


def test_ids_equal_the_tokenizers():
    own, other = packing.Ids(), _tokenizer()
    for text in [*_hostile(1, 4_000), "x" * 3_000, "word " * 2_000, "é" * 700 + " \n " * 50]:
        assert np.frombuffer(own.of(text), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def _fits(some, rooms):
    return not some or any(r >= some[0] and _fits(some[1:], [*rooms[:i], r - some[0], *rooms[i + 1:]])
                           for i, r in enumerate(rooms))


def test_bound_and_fit_against_all_packings():
    rng = random.Random(3)
    for _ in range(300):
        some = sorted((rng.randrange(1, 25) for _ in range(8)), reverse=True)
        least = next(k for k in range(1, 9) if _fits(some, [24] * k))
        sequence, offset, free = packing.best_fit(some, 24)
        bound = packing.least_sequences(np.array(some), 24)
        assert bound <= least <= len(free)
        for s in set(sequence):
            own = [(o, x) for q, o, x in zip(sequence, offset, some, strict=True) if q == s]
            assert [o for o, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]
            assert sum(x for _, x in own) == 24 - free[s]
    assert packing.least_sequences(np.array([], int), 24) == 0
    # Three of 9 do not share two sequences of 17, though their sum would.
    assert packing.least_sequences(np.array([9, 9, 9]), 17) == 3


def _whole(rows, texts, capacity):
    """Every document's ids once, in pieces; every sequence gapless."""
    coder = _tokenizer()
    want = []
    for doc_id, text in texts:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(itertools.pairwise(cuts)):
            want.append((doc_id, i, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_rounds_of_exchange_keep_every_piece(spark):
    rng = random.Random(8)
    texts = [(i, " ".join(rng.choice(("one", "two", "three")) for _ in range(rng.randrange(1, 90)))) for i in range(900)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    cut = packing.pieces(frame, 32)
    once = packing.packed(cut, 32, part=60, group=200, rounds=0).collect()
    found = packing.packed(cut, 32, part=60, group=200).collect()
    again = packing.packed(cut.repartition(5), 32, part=60, group=200).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    before, after = _whole(once, texts, 32), _whole(found, texts, 32)
    lengths = np.array([r.length for r in found])
    assert packing.least_sequences(lengths, 32) <= after <= before
    assert after < before and after <= 1.03 * packing.least_sequences(lengths, 32)
    assert max(r.round for r in found) > 0
    sums = packing.report(spark.createDataFrame(found)).collect()
    assert sum(r.sequences for r in sums) == after and sum(r.ids for r in sums) == lengths.sum()


def test_nulls_copies_long_texts_and_empty_table(spark):
    texts = [(None, None), (1, ""), (2, None), (3, "word " * 5_000), (None, "x"), (3, "word " * 5_000)]
    texts += [(9, "same text")] * 3_000
    frame = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, part int, length int")
    rows = packing.packed(packing.pieces(frame), part=500).collect()
    assert _whole(rows, texts, 1_024) >= 1
    assert packing.packed(packing.pieces(frame.limit(0))).count() == 0
