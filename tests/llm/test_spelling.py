"""Spelling variants against all pairs."""

import random
import re
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from depotline.llm import spelling


def _edits(word, letters):
    for i in range(len(word) + 1):
        yield word[:i] + word[i + 1:]
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1:]


def _variants(rows):
    seen = Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}
    letters = set("".join(w for w in words if len(w) < 1_000))
    form, near_of = {}, {}
    for w in words:
        near = {e for e in _edits(w, letters) if e in words and e != w} if len(w) < 1_000 else {
            e for e in words if spelling.one_edit(w, e)}
        near_of[w] = near
        best = min(near, key=lambda e: (-words[e], e), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near_of[w]), words.get(form[w])))
    return sorted(out, key=str)


def _equal(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, word string")
    found = spelling.variants(frame)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(map(tuple, found.collect()), key=str)
    want = _variants(rows)
    assert got == want
    return got


def test_one_edit():
    for a, b, same in (("abcde", "abcde", False), ("abcde", "abxde", True), ("abcde", "abcdef", True),
                       ("abcde", "bcde", True), ("aabb", "abab", False), ("", "a", True), ("ab", "cd", False),
                       ("abc", "abcde", False)):
        assert spelling.one_edit(a, b) is same and spelling.one_edit(b, a) is same


def test_random_words_of_few_letters(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choice("abé") for _ in range(rng.randrange(3, 9)))
                         for _ in range(700))) for i in range(12)]
    assert len(_equal(spark, rows)) > 500


def test_chains_repeats_case_accents_and_signs(spark):
    words = (["Hello"] * 40 + ["hallo"] * 9 + ["hallos"] * 4 + ["xhallos"] * 3 + ["aaaaa", "aaaaaa"] * 3
             + ["Éclair"] * 3 + ["éclair"] * 6 + ["na×me÷s"] * 3 + ["ſtraße"] * 3 + ["kelvin"] * 3)
    _equal(spark, [(None, " ".join(words)), (0, "123,".join(words)), (7, None), (8, ""), (8, "")])


def test_words_of_the_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").collect()]
    assert len(_equal(spark, rows)) > 500


def test_very_long_words(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh") for _ in range(60_000))
    rows = [(i, " ".join([long, long[:50_000] + "z" + long[50_001:], long[:9] + long[10:]])) for i in range(3)]
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((len(r.word), r.n_near) for r in got) == [(59_999, 1), (60_000, 1), (60_000, 2)]


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(frame).count() == 0
    few = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    assert spelling.variants(few.withColumn("id", F.lit(1))).count() == 0
