"""Quality as a Bradley-Terry ranking learnt from preference pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.rules import CAPITALS, SPACES, SYMBOLS, duplicate_lines, repeated_words
from depotline.llm.training import described, labelled, summed
from depotline.session import written

# Texts of the more frequent label in a block whose pairs are learnt from, and of the other at least.
BLOCK, LEAST = 128, 16
# Steps in which scores are counted for a quantile.
STEPS = 4_096
_DIGITS = b"0123456789"


def features(text: str) -> list[float]:
    """Shape of a text, whatever its language: shares per word, per letter and per line."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * FEATURES
    letters = len(text) - sum(map(text.count, SPACES))
    kinds = len(set(words))
    again, lines = duplicate_lines(text)
    same = sum(map(bytes.__eq__, words, words[1:]))
    symbols = sum(map(text.count, SYMBOLS))
    commas, ends = text.count(","), text.count(".")
    return [
        np.log1p(n), letters / n, np.log1p(max(map(len, words))), kinds / n, np.log1p(n / kinds),
        repeated_words(words) / n, same / n, again / lines, np.log1p(100 * lines / n),
        np.log1p(10 * symbols / n), np.log1p(10 * text.count("|") / n),
        np.log1p(10 * text.count("!") / n), np.log1p(10 * commas / n), np.log1p(10 * ends / n),
        (len(raw) - len(raw.translate(None, CAPITALS))) / letters,
        (len(raw) - len(raw.translate(None, _DIGITS))) / letters, (len(raw) - len(text)) / letters,
        sum(len(w) == 1 for w in words) / n, float(n < 50), symbols / letters,
    ]


FEATURES = 20


@dataclass
class Model:
    """Score of a text: weights @ standard features; 0.5 falls on the quantile `cut`."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    width: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.spread, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.raw(rows) - self.cut) / self.width, -40, 40)))


def _blocks(rows: DataFrame, kinds: dict[int, int]) -> DataFrame:
    """(good, bad) of every block of about BLOCK texts of the more frequent label, written once.

    Every text is in a block. Texts of the rarer label are dealt into as many blocks as it
    takes for a block to hold about LEAST of them, so that all blocks have pairs.
    """
    blocks = -(-max(kinds.values()) // BLOCK)
    times = {y: min(blocks, -(-LEAST * blocks // n)) for y, n in kinds.items()}
    names = [f"x{i}" for i in range(FEATURES)]
    turns = F.when(F.col("y") == 1, F.lit(times[1])).otherwise(F.lit(times[0]))
    dealt = rows.select("id", "y", F.array(*names).alias("x"), F.explode(F.transform(
        F.sequence(F.lit(0), turns - 1),
        lambda i: F.pmod(F.xxhash64("id", F.lit(3)) + i * F.floor(F.lit(blocks) / turns), F.lit(blocks)))).alias("block"))

    def side(y: int):
        mine = F.sort_array(F.collect_list(F.when(F.col("y") == y, F.struct("id", "x"))))
        return F.flatten(F.transform(mine, lambda r: r["x"]))

    return written(dealt.groupBy("block").agg(side(1).alias("good"), side(0).alias("bad")), "pairs")


def _pair_sums(mean: np.ndarray, spread: np.ndarray):
    """Gradient, Hessian and number of the pairs of a batch of blocks, one after the other."""
    def standard(flat: pa.ListScalar) -> np.ndarray:
        rows = flat.values.to_numpy().reshape(-1, FEATURES)
        return np.clip((rows - mean) / spread, -8, 8)

    def sums(w: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(FEATURES + FEATURES ** 2 + 1)
        for k in range(batch.num_rows):
            good, bad = standard(batch.column("good")[k]), standard(batch.column("bad")[k])
            diff = (good[:, None] - bad[None]).reshape(-1, FEATURES)
            p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
            total[:FEATURES] -= diff.T @ p
            total[FEATURES:-1] += ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()
            total[-1] += len(diff)
        return total

    return sums


def _quantile(scores: DataFrame, weight: dict[int, float], part: float) -> float:
    """The middle between the least score of rows (s, y) up to which a `part` of all weight
    lies, and the next one; counted in ever finer steps, exactly."""
    below, (low, high) = 0.0, scores.agg(F.min("s"), F.max("s")).first()
    rows = scores
    while low < high:
        step = (high - low) / STEPS
        found: dict[int, list] = {}
        bins = F.least(F.floor((F.col("s") - low) / step), F.lit(STEPS))
        for r in rows.groupBy(bins.alias("bin"), "y").agg(
                F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).collect():
            one = found.setdefault(r["bin"], [0.0, r["low"], r["high"]])
            one[:] = one[0] + weight[r["y"]] * r["n"], min(one[1], r["low"]), max(one[2], r["high"])
        for k in sorted(found):
            mass, low, high = found[k]
            if below + mass >= part - 1e-12 or k == max(found):
                break
            below += mass
        rows = scores.filter(F.col("s").between(low, high))
    after = scores.filter(F.col("s") > low).agg(F.min("s")).first()[0]
    return low if after is None else (low + after) / 2


def fit(texts: DataFrame, share: float) -> Model | None:
    """Scores that order preference pairs, and the quantile that cuts them, from rows (text, y).

    In a pair the text labelled 1 is preferred; P(a over b) = 1 / (1 + exp(s(b) - s(a))), and
    the weights of s minimise the logistic loss on feature differences, with a small ridge.
    Every text takes part: texts are dealt into blocks by hash, and all pairs of a block count.
    `share` is the part of texts labelled 1; the cut is the score's quantile that leaves so
    many above when all texts are weighed to that share. None where a label is missing.
    """
    rows = described(texts, lambda some: np.array([features(t) for t in some]).reshape(-1, FEATURES),
                     FEATURES, "features")
    kinds = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return None
    names = [f"x{i}" for i in range(FEATURES)]
    moments = rows.agg(*(F.avg(n) for n in names), *(F.stddev_pop(n) for n in names)).first()
    mean, spread = np.array(moments[:FEATURES]).round(9), np.array(moments[FEATURES:]).round(9) + 1e-6
    pairs, sums = _blocks(rows, kinds), _pair_sums(mean, spread)
    w = np.zeros(FEATURES)
    for _ in range(60):  # Newton steps
        found = summed(pairs, sums, w)
        grad = found[:FEATURES] / found[-1] + 1e-3 * w
        hess = found[FEATURES:-1].reshape(FEATURES, FEATURES) / found[-1] + 1e-3 * np.eye(FEATURES)
        move = np.linalg.solve(hess, grad)
        w = w - move * min(1.0, 2 / (1e-9 + np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    # So that the order in which tasks are added up does not show.
    model = Model(mean, spread, w.round(6), 0.0, 1.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
            yield pa.record_batch([pa.array(model.raw(x), pa.float64()), batch.column("y")], names=["s", "y"])

    scores = written(rows.mapInArrow(work, "s double, y int"), "raw")
    cut = _quantile(scores, {1: share / kinds[1], 0: (1 - share) / kinds[0]}, 1 - share)
    width = scores.agg(F.stddev_pop("s")).first()[0] / 4
    return Model(mean, spread, model.weights, cut, round(max(width, 1e-6), 9))


def scored(documents: DataFrame, labels: DataFrame, out: str = "score") -> DataFrame:
    """The documents with a quality score in [0, 1] in column `out`; 0.5 is the cut.

    The label `quality` is learnt from all labelled documents (see `labelled`); the score
    reads the whole text and nothing else, so equal texts and repeated rows score the same. Null
    and wordless texts score 0. Without labels of both kinds every text scores 0.5. A column
    named `out` is replaced. An empty table gives an empty one.
    """
    base = documents.drop(out)
    known = labels.filter(F.col("quality").isNotNull())
    share = known.filter((F.crc32(F.col("doc_id").cast("string")) % 3) != 1).agg(
        F.avg("quality")).first()[0]
    model = fit(labelled(documents, labels, "quality"), share)
    if model is None:
        return base.withColumn(out, F.lit(0.5))
    schema = base.withColumn(out, F.lit(0.0)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = np.array([features(t or "") for t in texts]).reshape(-1, FEATURES)
            wordy = np.array([bool((t or "").split()) for t in texts], bool)
            yield pa.record_batch(
                [*batch.columns, pa.array(np.where(wordy, model.scores(rows), 0.0), pa.float64())],
                names=[*batch.schema.names, out])

    return base.mapInArrow(work, schema)
