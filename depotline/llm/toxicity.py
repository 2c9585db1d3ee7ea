"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks.

Strings are compared by their common subsequences of three letters, each weighted by DECAY to
the power of the letters it spans, so an insult still matches with letters put in or left out.
The unit is a word in lower case; signs inside it are dropped, digits read as
the letters they stand for, runs of a letter shortened to two, and letters standing alone in
a row are joined.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import SENTENCE_END, fresh
from depotline.llm.training import described, labelled, summed
from depotline.session import written

LANDMARKS = 160
# Words that the machine is fitted on, at most: the most frequent toxic ones, clean ones drawn at
# first, the hardest of all clean ones that a round adds, and of both those that landmarks are
# chosen among.
MOST_TOXIC, MOST_CLEAN, HARDEST, TOXIC_MARKS, CLEAN_MARKS = 1_000, 5_000, 1_500, 400, 300
# Pairs of words that a task holds before it hands them on, and words whose letters it remembers.
HELD = 400_000
DECAY, SPAN = 0.6, 7
# Marks of a text, and from how far below the border on a word counts in them.
MARKS, NEAR = 4, 0.5
THRESHOLD = 0.7
LETTERS = 64
# Digits and signs that stand for letters.
STANDS_FOR = str.maketrans("013457@$", "oieastas")
# The other signs of ASCII, and what becomes of each sign inside a word.
_SIGNS = "".join(c for c in map(chr, range(128)) if not c.isalpha())
_INSIDE = {**dict.fromkeys(map(ord, _SIGNS)), **STANDS_FOR}
_RUN = re.compile(r"(.)\1{2,}")
_PAIRS = [(p, q) for q in range(2, SPAN) for p in range(1, q)]
CELLS = 100_000


def unit(word: str) -> str:
    """The letters of a word, for comparison."""
    return _RUN.sub(r"\1\1", _letters(word.lower()))


def _letters(word: str) -> str:
    """The letters of a word in lower case, with those that signs inside it stand for."""
    if word.isascii():
        if not word.isalpha():
            word = word.strip(_SIGNS)
            if not word.isalpha():
                word = word.translate(_INSIDE)
        return word
    if not word.isalpha():
        first = next((i for i, c in enumerate(word) if c.isalpha()), len(word))
        last = next((i for i in range(len(word), first, -1) if word[i - 1].isalpha()), first)
        word = word[first:last].translate(STANDS_FOR)
    word = unicodedata.normalize("NFKC", word)
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _unit_of(words: set[str]) -> dict[str, str]:
    """The unit of every word (none holds white space), worked out over all words as one string."""
    if not words:
        return {}
    lower = "\n".join(words).lower().split("\n")
    letters = "\n".join([w if w.isascii() and w.isalpha() else _letters(w) for w in lower])
    return dict(zip(words, _RUN.sub(r"\1\1", letters).split("\n"), strict=True))


def joined_letters(words: list[str]) -> list[str]:
    """Words spelt out: three or more letters in a row that stand alone."""
    alone = [i for i, w in enumerate(words) if len(w) == 1]
    found, start = [], 0
    for k in range(1, len(alone) + 1):
        if k == len(alone) or alone[k] != alone[k - 1] + 1:
            if k - start > 2:
                found.append("".join(words[alone[start]:alone[k - 1] + 1]))
            start = k
    return found


def units(sentence: str) -> set[str]:
    """Every unit of a sentence."""
    words = [unit(w) for w in sentence.split()]
    return {w for w in [*words, *joined_letters(words)] if len(w) > 2}


def _codes(words: list[str]) -> np.ndarray:
    """Letters as numbers, filled up with 0; a to z are 1 to 26, others share the rest."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    coded = np.where((flat >= 97) & (flat <= 122), flat - 96,
                     np.where(flat == 0, 0, 27 + flat % (LETTERS - 27)))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), lengths.max()), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = coded
    return out


def _scale(lengths: np.ndarray) -> np.ndarray:
    """Norm of a string of that length whose subsequences all differ."""
    total = np.zeros(len(lengths))
    for _, q in _PAIRS:
        total += np.maximum(lengths - q, 0) * DECAY ** (2 * q)
    return np.sqrt(np.maximum(total, 1e-12))


def weigh_all(words: list[str], marks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Kernel of every word with strings given by their subsequences (places, weights)."""
    out = np.zeros((len(words), len(marks)), np.float32)
    table = np.zeros(LETTERS ** 3, np.float32)
    for part, cells in _cells(words):
        scale = _scale(np.array([len(words[i]) for i in part.tolist()]))
        for t, (places, weights) in enumerate(marks):
            table[places] = weights
            total = sum(DECAY ** q * table[at].sum(axis=1) for q, at in cells)
            out[part, t] = total / scale
            table[places] = 0
    return out


def _cells(words: list[str]) -> Iterator[tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
    """Words of like lengths, with the places of their subsequences by last letter's distance."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        part = order[start:start + CELLS]
        filled = np.arange(1, len(part) + 1) * lengths[part]
        part = part[:max(1, int(np.searchsorted(filled, CELLS, "right")))]
        codes = _codes([words[i] for i in part.tolist()])
        width = codes.shape[1]
        first, second = codes * LETTERS ** 2, codes * LETTERS
        yield part, [(q, first[:, :width - q] + second[:, p:width - q + p] + codes[:, q:])
                     for p, q in _PAIRS if width > q]
        start += len(part)


def weigh(words: list[str], table: np.ndarray) -> np.ndarray:
    """Inner product of every word's subsequences with a table of weights, over the word's norm."""
    out = np.zeros(len(words))
    for part, cells in _cells(words):
        total = sum(DECAY ** q * table[at].sum(axis=1) for q, at in cells)
        out[part] = total / _scale(np.array([len(words[i]) for i in part.tolist()]))
    return out


def subsequences(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of a word's subsequences, over its norm."""
    codes = _codes([word])[0]
    places, weights = [], []
    for p, q in _PAIRS:
        n = len(codes) - q
        if n > 0:
            places.append((codes[:n] * LETTERS + codes[p:n + p]) * LETTERS + codes[q:])
            weights.append(np.full(n, DECAY ** q))
    if not places:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    at, kind = np.unique(np.concatenate(places), return_inverse=True)
    scale = _scale(np.array([len(word)]))[0]
    return at, (np.bincount(kind, np.concatenate(weights)) / scale).astype(np.float32)


@dataclass
class Model:
    """f(word) = <subsequences of word, table> + bias; odds of a text = <marks of text, odds> + offset."""

    table: np.ndarray
    bias: float
    odds: np.ndarray
    offset: float
    most: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        return weigh(words, self.table) + self.bias

    def probabilities(self, marks: np.ndarray) -> np.ndarray:
        """Of texts, given their marks (see `_marks`); beyond the sample's largest nothing was learnt."""
        known = np.minimum(marks, self.most)
        return 1 / (1 + np.exp(-np.clip(known @ self.odds + self.offset, -40, 40)))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge, weighted), by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x1.shape[1], 1e-4)
    ridge[-1] = 0
    step = 1 / (2 * np.linalg.norm(x1 * np.sqrt(weight)[:, None], 2) ** 2 + 1e-4)
    w = v = np.zeros(x1.shape[1])
    for t in range(600):
        gap = np.maximum(0, 1 - y * (x1 @ v))
        new = v - step * (-2 * x1.T @ (weight * y * gap) + ridge * v)
        w, v = new, new + t / (t + 3) * (new - w)
    return w[:-1], float(w[-1])


def _landmarks(positive: list[str], negative: list[str]) -> list[str]:
    """Strings far from each other, picked one by one by the largest residual of the kernel."""
    pool = [*positive, *negative]
    residual = np.ones(len(pool))
    residual[:len(positive)] = 4.0  # positives first, where residuals are alike
    rows: list[np.ndarray] = []
    chosen: list[int] = []
    for _ in range(min(LANDMARKS, len(pool))):
        i = int(np.argmax(residual))
        if residual[i] < 1e-3:
            break
        row = weigh_all(pool, [subsequences(pool[i])])[:, 0]
        for r in rows:
            row = row - r * r[i]
        row = row / np.sqrt(max(row[i], 1e-6))
        rows.append(row)
        chosen.append(i)
        residual = residual - row ** 2
        residual[chosen] = -1
    return [pool[i] for i in chosen]


def followed(texts: DataFrame) -> DataFrame:
    """(word, toxic, clean): how many different words each word follows in the sentences of the rows
    (text, y) that are labelled 1 and 0, as a written table. Copies of a document add nothing."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        held: tuple[set, set] = (set(), set())
        known: dict[str, str] = {}

        def handed() -> pa.RecordBatch:
            rows = [(word, y, before) for y in (0, 1) for before, word in held[y] if len(word) > 2]
            befores = np.array([xxh64_intdigest(r[2]) for r in rows], np.uint64).view(np.int64)
            for some in held:
                some.clear()
            return pa.record_batch([pa.array([r[0] for r in rows], pa.string()),
                                    pa.array([r[1] for r in rows], pa.int32()),
                                    pa.array(befores, pa.int64())], names=["word", "y", "before"])

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                sentences = [sentence.split() for sentence in SENTENCE_END.split(text)]
                known.update(_unit_of(set().union(*sentences).difference(known)))
                for words in sentences:
                    some = list(map(known.__getitem__, words))
                    held[y].update(zip(["", *some], some))  # noqa: B905
                if len(known) > HELD:
                    known.clear()
                if len(held[0]) + len(held[1]) > HELD:
                    yield handed()
        yield handed()

    pairs = texts.mapInArrow(work, "word string, y int, before long").distinct()
    return written(pairs.groupBy("word").agg(F.count_if(F.col("y") == 1).alias("toxic"),
                                             F.count_if(F.col("y") == 0).alias("clean")), "followed")


def _standing_out(words: DataFrame, sums) -> DataFrame | None:
    """The words that toxic sentences have far more often than by chance.

    With so many words, so many finds in toxic sentences alone happen to less than one word in ten
    samples. Where too few sentences are labelled for any word to stand out so far, more
    chance is allowed, step by step.
    """
    ratio = sums["clean"] / max(1, sums["toxic"])
    for samples in (10.0, 1.0, 0.1) if ratio else ():
        least = np.log1p(samples * max(10, sums["kinds"])) / np.log1p(ratio)
        found = words.filter(F.col("toxic") > float(least) + F.col("clean") * 4 * max(1.0, 1 / ratio))
        if found.limit(1).count():
            return found
    return None


def _hardest(clean: DataFrame, model: Model) -> list[str]:
    """Of all rows (word) those that score highest."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            yield pa.record_batch([batch.column("word"), pa.array(
                model.scores(words) if words else [], pa.float64())], names=["word", "score"])

    rows = clean.select("word").mapInArrow(work, "word string, score double")
    return [r["word"] for r in rows.orderBy(F.desc("score"), "word").limit(HARDEST).collect()]


def fit(texts: DataFrame) -> Model | None:
    """Train on the sentences of rows (text, y), which carry their document's label; None where a
    label is missing.

    A clean document's sentences are clean. A toxic document's are toxic where they hold a word
    that toxic sentences have far more often than clean ones, counted by the words it follows;
    its others are left out. The
    machine separates those words from the clean ones, hardest of all clean words mined in rounds.
    Counts, mining and the odds of a text cover all rows.
    """
    worded = {r["y"] for r in texts.filter(F.col("text").rlike(r"[^\s.!?]")).select("y").distinct().collect()}
    if len(worded) < 2:
        return None
    words = followed(texts)
    sums = words.agg(F.coalesce(F.sum("clean"), F.lit(0)).alias("clean"),
                     F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
                     F.count_if(F.col("toxic") > 0).alias("kinds")).first()
    found = _standing_out(words, sums)
    seen = {} if found is None else {r["word"]: r["toxic"] for r in found.orderBy(
        F.desc("toxic"), "word").limit(MOST_TOXIC).collect()}
    positive = list(seen)
    clean = words.filter((F.col("clean") > 0) & ~F.col("word").isin(positive)) if positive else None
    drawn = [] if clean is None else clean.orderBy(F.xxhash64("word"), "word").limit(MOST_CLEAN).collect()
    if not drawn:
        raise ValueError("toxic: labels of both kinds exist, but no word tells them apart")
    rng = np.random.default_rng(5)
    negative = [r["word"] for r in drawn]
    marks = _landmarks(positive[:TOXIC_MARKS], negative[:CLEAN_MARKS])
    tables = [subsequences(m) for m in marks]
    gram = weigh_all(marks, tables)
    values, vectors = np.linalg.eigh((gram + gram.T).astype(float) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T  # K^(-1/2)
    bent = [(v, seen[w] * 0.2) for w in positive for v in _bent(w, rng)]
    weights = np.array([*(float(seen[w]) for w in positive), *(n for _, n in bent)])
    toxic = weigh_all([*positive, *(v for v, _ in bent)], tables) @ root
    benign = weigh_all(negative, tables) @ root
    for turn in range(4):
        y = np.concatenate([np.ones(len(toxic)), -np.ones(len(benign))])
        weight = np.concatenate([weights / weights.sum(), np.full(len(benign), 1 / len(benign))])
        w, bias = _squared_hinge(np.vstack([toxic, benign]), y, weight)
        table = np.zeros(LETTERS ** 3, np.float32)
        for weight_of, (places, weights_of) in zip(root @ w, tables, strict=True):
            table[places] += np.float32(weight_of) * weights_of
        model = Model(table, bias, np.zeros(MARKS), 0.0, np.zeros(MARKS))
        if turn < 3:
            held = set(negative)
            more = [h for h in _hardest(clean, model) if h not in held]
            negative += more
            if more:
                benign = np.vstack([benign, weigh_all(more, tables) @ root])
    return _calibrated(model, texts)


def _bent(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter put in, and with one doubled."""
    if len(word) < 5:
        return []
    at = int(rng.integers(1, len(word)))
    strange = "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(26))]
    return [word[:at] + strange + word[at:], word[:at] + word[at - 1] + word[at:]]


def _marks(scores: np.ndarray) -> tuple[float, ...]:
    """What all words of a text say together, from the scores of its words, repeats included.

    The worst word; how much of the text lies near or beyond the border; how many words lie
    beyond it; the mean of the worst five. So a stem that runs through a text weighs more than
    one that a clean text holds once, and one insult still shows in a long text.
    """
    if not len(scores):
        return (-2.0, 0.0, 0.0, -2.0)
    worst = -np.sort(-scores)[:5]
    return (min(worst[0], 1.0), 50 * np.maximum(scores + NEAR, 0).sum() / (len(scores) + 20),
            float(np.log1p((scores > 0).sum())), worst.mean())


def _odds_sums(scale: np.ndarray, weight: dict[int, float], used: list[int]):
    """Gradient and Hessian of the weighted logistic loss over a batch of marks."""
    middle, spread = scale

    def sums(v: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        m = np.stack([batch.column(f"x{i}").to_numpy() for i in range(MARKS)], axis=1)
        some = np.hstack([(m - middle) / spread, np.ones((len(m), 1))])[:, used]
        y = batch.column("y").to_numpy().astype(float)
        each = np.where(y == 1, weight[1], weight[0])
        p = 1 / (1 + np.exp(-np.clip(some @ v, -40, 40)))
        hess = (some * (each * p * (1 - p))[:, None]).T @ some
        return np.concatenate([some.T @ (each * (p - y)), hess.ravel()])

    return sums


def _calibrated(model: Model, texts: DataFrame) -> Model:
    """Fit the odds of a document's label on its marks, both labels of equal weight in sum."""
    def figures(some: list[str]) -> np.ndarray:
        # One scorer a task, so that it remembers its words.
        if not scorers:
            scorers.append(_Scorer(shared.value))
        return scorers[0].marks(some).reshape(-1, MARKS)

    scorers: list[_Scorer] = []
    shared = texts.sparkSession.sparkContext.broadcast(model)
    marks = described(texts, figures, MARKS, "marks")
    names = [f"x{i}" for i in range(MARKS)]
    kinds = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    weight = {y: 0.5 / kinds[y] for y in (0, 1)}
    found = marks.agg(*(f(n) for f in (F.avg, F.stddev_pop, F.max) for n in names)).first()
    middle, spread, most = np.array(found, float).reshape(3, MARKS)
    middle, spread = middle.round(9), spread.round(9) + 1e-9
    # A mark may speak for toxicity or not at all; one that would speak against it is left out.
    used = [*range(MARKS + 1)]
    while True:
        sums, ridge = _odds_sums((middle, spread), weight, used), np.diag([0.005] * (len(used) - 1) + [1e-9])
        v = np.zeros(len(used))
        for _ in range(200):
            got = summed(marks, sums, v)
            grad = got[:len(used)] + ridge @ v
            move = np.linalg.solve(got[len(used):].reshape(len(used), -1) + ridge, grad)
            v = v - move
            if np.abs(move).max() < 1e-9:
                break
        if v[:-1].min(initial=0.0) >= 0:
            break
        used.pop(int(v[:-1].argmin()))
    w = np.zeros(MARKS + 1)
    # So that the order in which tasks are added up does not show.
    w[used] = v.round(7)
    odds = w[:-1] / spread
    return Model(model.table, model.bias, odds, float(w[-1] - odds @ middle), most)


class _Scorer:
    """Marks of texts; scores of words are remembered up to a number of words."""

    def __init__(self, model: Model, most: int = 400_000) -> None:
        self.model, self.most = model, most
        self.known: dict[str, float] = {}
        self.short: dict[str, str] = {}

    def marks(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        if len(self.short) > self.most:
            self.short.clear()
        words = [text.split() for text in texts]
        kinds = set().union(*words)
        self.short.update(_unit_of({w for w in kinds if len(w) < 4}.difference(self.short)))
        spelt = [self._spelt(some) for some in words]
        new = _unit_of(kinds.union(*spelt).difference(self.known))
        todo = sorted({u for u in new.values() if len(u) > 2})
        got = dict(zip(todo, self.model.scores(todo).tolist(), strict=True)) if todo else {}
        self.known.update((w, got.get(u, -2.0)) for w, u in new.items())
        known = self.known
        return np.array([_marks(np.fromiter(map(known.__getitem__, [*some, *extra]), float))
                         for some, extra in zip(words, spelt, strict=True)])

    def _spelt(self, words: list[str]) -> list[str]:
        """Words spelt out in a text; only words that are short to begin with stand alone."""
        if list(map(len, words)).count(1) < 3:
            return []
        return joined_letters(list(map(self.short.get, words, words)))


def scored(documents: DataFrame, labels: DataFrame, out: str = "score") -> DataFrame:
    """The documents with the probability of being toxic in column `out`.

    The label `toxic` is learnt from all labelled documents (see `labelled`); a text scores by
    all its words, whole. Null, empty and wordless texts score lowest. Without labels of both kinds
    every text scores 0. Equal texts score the same; a column named `out` is replaced.
    """
    base = documents.drop(out)
    model = fit(labelled(documents, labels, "toxic"))
    if model is None:
        return base.withColumn(out, F.lit(0.0))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = base.withColumn(out, F.lit(0.0)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = _Scorer(own)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                found = own.probabilities(scorer.marks(texts))
                yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())],
                                      names=[*batch.schema.names, out])

    return base.mapInArrow(work, schema)


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    score, = fresh(documents, "_toxic")
    return (scored(documents, labels, score).filter(F.col(score) < threshold)
            .select(*documents.columns))
