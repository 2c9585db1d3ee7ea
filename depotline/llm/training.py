"""Labelled documents to learn from: all of them, or a bounded sample for the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import id_remainder, plain
from depotline.session import written


# Steps in which a share is drawn, fine enough for any number of labels.
FINE = 10 ** 15


def labelled(documents: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(text, y) of every labelled document to learn from, whole, as a written table.

    Taken are all documents whose id leaves a remainder other than 1 by 3. Null labels and ids are
    not used; a document with labels that differ counts as 1.
    """
    learnt = id_remainder("doc_id", 3) != 1
    known = (labels.filter(learnt & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).filter("y IN (0, 1)"))
    # Labels grow with the documents, so they are not sent to every task even where they are few.
    return written(documents.filter(learnt).select("doc_id", plain("text").alias("text"))
                   .join(known.hint("merge"), "doc_id").select("text", "y"), "labelled")


def described(texts: DataFrame, figures: Callable[[list[str]], np.ndarray], width: int,
              purpose: str) -> DataFrame:
    """(id, y, x0, x1, ...) of every different text and label of rows (text, y), as a written table;
    the id is the text's 64-bit hash."""
    names = [f"x{i}" for i in range(width)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                x = figures(batch.column("text").to_pylist())
                yield pa.record_batch([batch.column("id"), batch.column("y"),
                                       *(pa.array(x[:, i], pa.float64()) for i in range(width))],
                                      names=["id", "y", *names])

    rows = texts.select(F.xxhash64("text").alias("id"), "y", "text").mapInArrow(
        work, "id long, y int, " + ", ".join(f"{n} double" for n in names))
    return written(rows.groupBy("id", "y").agg(*(F.first(n).alias(n) for n in names)), purpose)


def summed(rows: DataFrame, sums: Callable[[np.ndarray, pa.RecordBatch], np.ndarray],
           at: np.ndarray) -> np.ndarray:
    """The sum over all batches of what `sums` makes of the parameters `at` and a batch.

    One step of a fit: every task adds up its own rows and hands on one row of figures.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                found = sums(at, batch)
                total = found if total is None else total + found
        if total is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                   pa.array([total], pa.list_(pa.float64()))], names=["part", "figures"])

    found = rows.mapInArrow(work, "part int, figures array<double>").collect()
    return np.sum([r["figures"] for r in sorted(found)], axis=0)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                    most_chars: int) -> list[tuple[str, int]]:
    """About `per_class` texts of each label at most, for a model that is fitted on the driver.

    Taken are documents of up to `most_chars` characters whose id leaves a remainder other
    than 1 by 3, chosen by a hash of the id, so that the sample is the same in every run. Null
    labels and ids are not used; a document with labels that differ counts as 1. The share is
    drawn from documents that fit the bound. Raises a ValueError if there are documents with labels
    of both kinds but the sample holds none of one.
    """
    known = (labels.filter((id_remainder("doc_id", 3) != 1) & F.col(label).isNotNull()
                           & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(label).alias("_label")))
    fitting = (documents.filter(F.char_length(plain("text")) <= most_chars)
               .select("doc_id").distinct().join(known, "doc_id"))
    counts = {r[0]: r[1] for r in fitting.groupBy("_label").count().collect()}
    chosen = None
    for value in (0, 1):
        share = min(1.0, per_class / max(1, counts.get(value, 0)))
        some = known.filter((F.col("_label") == value) & (F.pmod(
            F.xxhash64(F.lit(value), "doc_id"), F.lit(FINE)) < int(share * FINE)))
        chosen = some if chosen is None else chosen.union(some)
    rows = (documents.select("doc_id", plain("text").alias("_text"))
            .filter(F.char_length("_text") <= most_chars)
            .join(chosen, "doc_id")
            .groupBy("doc_id", "_label").agg(F.min("_text").alias("_text")).collect())
    found = sorted({(r["_text"], int(r["_label"])) for r in rows})
    kinds = {y for _, y in found}
    told = known.join(documents.select("doc_id").distinct(), "doc_id").select("_label").distinct()
    if len(kinds) < 2 and {r[0] for r in told.collect()} >= {0, 1}:
        raise ValueError(f"{label}: labels of both kinds exist, but the sample holds {sorted(kinds)} only")
    return found
