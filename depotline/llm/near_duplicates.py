"""Near-duplicate documents by ProbMinHash signatures of word shingles.

Links are judged by the Jaccard similarity of sets, so every shingle has the same weight in the
signatures, however often a text repeats it: a register then agrees with odds of just that
similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import fresh, plain, token
from depotline.llm.similar import _GOLD, Words, linked, mixed, shingles
from depotline.session import written

LEAST = 0.8
# Two texts at the least similarity share one of the bands with odds 1 - (1 - 0.8^6)^32,
# that is all but one pair in 17,000; at 0.9 all but one in 10^10.
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
# Shingles that one vectorised step holds.
STEP = 200_000


def prob_minhash(grams: np.ndarray, weights: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """Signatures (texts x REGISTERS) of weighted sets, given as flat arrays.

    Each element of a set is a Poisson process whose rate is its weight; every arrival falls
    into a random register, which keeps the element that arrived first. So a register holds an
    element in proportion to its weight, and two sets agree in a register with odds equal to
    their probability Jaccard similarity. Rounds advance all processes by one arrival; one
    whose time passes the latest time in its set's registers can change nothing and ends.
    """
    first = np.full(texts * REGISTERS, np.inf)
    winner = np.zeros(texts * REGISTERS, np.uint64)
    latest = np.full(texts, np.inf)
    time = np.zeros(len(grams))
    turn = np.zeros(1, np.uint64)
    while len(grams):
        drawn = mixed(grams + turn * _GOLD)
        time = time - np.log(((drawn >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53) / weights
        alive = time < latest[of]
        grams, weights, of, time, drawn = (v[alive] for v in (grams, weights, of, time, drawn))
        register = ((mixed(drawn) >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        at = of * REGISTERS + register.astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = grams[won]
        open_texts = np.unique(of)
        latest[open_texts] = first.reshape(texts, REGISTERS)[open_texts].max(axis=1)
        turn += np.uint64(1)
    return winner.reshape(texts, REGISTERS)


def banded(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One bucket hash per band of `rows` registers."""
    texts, registers = signatures.shape
    cut = signatures.reshape(texts, registers // rows, rows)
    out = np.broadcast_to(np.arange(registers // rows, dtype=np.uint64), cut.shape[:2]).copy()
    for i in range(rows):
        out = mixed(out + cut[:, :, i] + _GOLD)
    return out.view(np.int64)


def signed(texts: DataFrame) -> DataFrame:
    """(id, bands) of rows (id, text); no bands where a text has no words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            out: list[np.ndarray] = []
            held: list[np.ndarray] = []
            for text in batch.column("text").to_pylist():
                held.append(np.unique(shingles(token(text), hashes)))
                if sum(len(g) for g in held[-64:]) > STEP or len(held) == 1_000:
                    out += _bands_of(held)
                    held = []
            out += _bands_of(held)
            yield pa.record_batch([batch.column("id"), pa.array(out, pa.list_(pa.int64()))],
                                  names=["id", "bands"])

    return texts.select("id", "text").mapInArrow(work, "id long, bands array<long>")


def _bands_of(held: list[np.ndarray]) -> list[np.ndarray]:
    if not held:
        return []
    counts = np.array([len(g) for g in held])
    grams = np.concatenate(held)
    weights = np.ones(len(grams))
    of = np.repeat(np.arange(len(held)), counts)
    bands = banded(prob_minhash(grams, weights, of, len(held)), ROWS)
    return [bands[i] if n else bands[i][:0] for i, n in enumerate(counts)]


def classes(documents: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """(node, component): texts, by their hash, that have a near copy, and their class.

    Two texts are linked if the Jaccard similarity of their sets of five-word shingles, A-Z in
    lower case, is at least `least`; classes are the components of the links. A text of
    fewer words is one shingle; texts without words are alike only if equal.
    """
    texts = documents.select(F.xxhash64(plain(text)).alias("id"), plain(text).alias("text"))
    signatures = written(signed(texts).dropDuplicates(["id"]), "near")
    bands = signatures.select(F.explode("bands").alias("band"), "id")
    return linked(bands, texts, least, "near")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, class_id (its class's least id), class_size, kept.

    Exact copies share a text and so a class; a null text equals an empty one. `kept` marks the
    document with the class's id. Null ids are not least unless a class has no other.
    Rows that repeat a document are members like any other, and are marked alike.
    Texts are told apart by a 64-bit hash: among 10^10 different texts about three pairs
    would be taken for copies.
    """
    members = (documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(plain(text)).alias("node"))
               .join(classes(documents, text, least), "node", "left")
               .select("doc_id", F.coalesce("component", "node").alias("_class")))
    sums = members.groupBy("_class").agg(F.min("doc_id").alias("class_id"),
                                         F.count("*").alias("class_size"))
    return members.join(sums, "_class").select(
        "doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicated(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """One document of each class, with the documents' own columns: the one with the least id.

    Of rows that repeat it, one stays.
    """
    node, group, best = fresh(documents, "_node", "_class", "_least")
    found = classes(documents, "text", least).select(F.col("node").alias(node),
                                                     F.col("component").alias(group))
    placed = (documents.withColumn(node, F.xxhash64(plain("text"))).join(found, node, "left")
              .withColumn(group, F.coalesce(group, node)))
    chosen = placed.groupBy(group).agg(F.min("doc_id").alias(best))
    return (placed.join(chosen, group).filter(F.col("doc_id").eqNullSafe(F.col(best)))
            .dropDuplicates([group]).select(*documents.columns))
