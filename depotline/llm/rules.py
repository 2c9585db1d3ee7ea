"""Quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import plain
from depotline.llm.training import FINE

# Fixed values of the base counts.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Bound of the sample that orders the rules: documents, and characters of one.
SAMPLE, SAMPLE_CHARS = 2_000, 20_000


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first time included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) < 2_000_000:  # three ids fit into 63 bits
        keys = (flat[:-2] * len(ids) + flat[1:-1]) * len(ids) + flat[2:]
        _, kind, count = np.unique(keys, return_inverse=True, return_counts=True)
    else:
        triples = np.stack([flat[:-2], flat[1:-1], flat[2:]], axis=1)
        _, kind, count = np.unique(triples, axis=0, return_inverse=True, return_counts=True)
    again = count[kind] > 1
    inside = np.zeros(n, bool)
    inside[:-2] |= again
    inside[1:-1] |= again
    inside[2:] |= again
    return int(inside.sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines)), len(lines)


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = text.encode("utf-8", "surrogatepass").split()
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            duplicate_lines(text)[0], repeated_words(words))


@dataclass(frozen=True)
class Rule:
    """A reason to reject a text."""

    name: str
    rejects: Callable[[str], bool]


def _few_words(text: str) -> bool:
    return len(text.encode("utf-8", "surrogatepass").split()) < 50


def _repetitive(text: str) -> bool:
    words = text.encode("utf-8", "surrogatepass").split()
    return 100 * repeated_words(words) > 50 * len(words)


def _symbols(text: str) -> bool:
    return 10 * sum(map(text.count, SYMBOLS)) > len(text.encode("utf-8", "surrogatepass").split())


def _lines(text: str) -> bool:
    again, lines = duplicate_lines(text)
    return 2 * again > lines


def _capitals(text: str) -> bool:
    raw = text.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return 10 * capitals > 3 * (len(text) - sum(map(text.count, SPACES)))


def _shouting(text: str) -> bool:
    return 10 * text.count("!") > 3 * len(text.encode("utf-8", "surrogatepass").split())


def _word_length(text: str) -> bool:
    n = len(text.encode("utf-8", "surrogatepass").split())
    letters = len(text) - sum(map(text.count, SPACES))
    return n > 0 and not 2 * n <= letters <= 20 * n


RULES = [
    Rule("few_words", _few_words), Rule("repetitive", _repetitive), Rule("symbols", _symbols),
    Rule("duplicate_lines", _lines), Rule("capitals", _capitals), Rule("shouting", _shouting),
    Rule("word_length", _word_length),
]


@dataclass(frozen=True)
class Measured:
    """A rule with its share of rejected texts and seconds a text, on the sample."""

    rule: Rule
    rejected: float
    seconds: float


def ordered(rules: list[Rule], sample: list[str]) -> list[Measured]:
    """The rules by rejection per cost, greedily: each next one is measured on what is left.

    The conjunction of the rules, and so the verdict, does not depend on the order. Rules that
    reject nothing more come last, cheap ones first.
    """
    left, todo, out = list(sample), list(rules), []
    while todo:
        best = None
        for rule in todo:
            begun = time.perf_counter()
            failed = [rule.rejects(t) for t in left]
            spent = (time.perf_counter() - begun) / max(1, len(left)) + 1e-9
            share = sum(failed) / max(1, len(left))
            rank = (share / spent, -spent)
            if best is None or rank > best[0]:
                best = rank, Measured(rule, share, spent), failed
        out.append(best[1])
        todo.remove(best[1].rule)
        left = [t for t, f in zip(left, best[2], strict=True) if not f]
    return out


def first_failed(text: str, rules: list[Rule]) -> str | None:
    """Name of the first rule that rejects the text; later ones are not run."""
    return next((r.name for r in rules if r.rejects(text)), None)


def sample_of(documents: DataFrame) -> list[str]:
    """A bounded sample of texts that orders the rules; it decides on speed only."""
    total = documents.count()
    share = min(1.0, SAMPLE / max(1, total))
    picked = documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FINE))
                              < int(share * FINE)).select(plain("text").alias("t"))
    return [r[0] for r in picked.filter(F.char_length("t") <= SAMPLE_CHARS)
            .limit(2 * SAMPLE).collect()]


def screened(documents: DataFrame, rules: list[Rule] = RULES, with_counts: bool = False) -> DataFrame:
    """The documents with `kept` and `rejected_by` (null if kept), and the base counts if wanted.

    Every rule sees the whole text; a null text is an empty one and has too few words. The
    name in `rejected_by` follows the measured order and may differ between runs where
    several rules reject a text; `kept` does not. Columns of the new names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    new = [*(names if with_counts else []), "kept", "rejected_by"]
    base = documents.drop(*new)
    order = [m.rule for m in ordered(rules, sample_of(documents))]
    schema = base
    for name in new:
        kind = "string" if name == "rejected_by" else "boolean" if name == "kept" else "long"
        schema = schema.withColumn(name, F.lit(None).cast(kind))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            columns = list(batch.columns)
            if with_counts:
                found = np.array([counts(t) for t in texts], np.int64).reshape(-1, len(names))
                columns += [pa.array(found[:, i]) for i in range(len(names))]
            reason = [first_failed(t, order) for t in texts]
            yield pa.record_batch(
                [*columns, pa.array([r is None for r in reason]), pa.array(reason, pa.string())],
                names=[*batch.schema.names, *new])

    return base.mapInArrow(work, schema.schema)


def accepted(documents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    own = documents.columns
    # Under names of its own, so that a column called kept survives.
    hidden = documents.toDF(*(c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(own)))
    return screened(hidden, rules).filter("kept").drop("kept", "rejected_by").toDF(*own)
