"""Packing of documents into sequences of one length: best fit, proven by bounds, repacked by exchange.

Partitions of pieces are packed by best-fit decreasing. Dual-feasible functions give a least number
of sequences for the same pieces; a partition that reaches it is certified. The others keep their
full sequences and give up the pieces of the rest, which meet those of other partitions in the
next round, where best-fit decreasing runs again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import plain
from depotline.session import written

CAPACITY = 1_024
END = 2
# Pieces of a partition in the first round, and of a group of partitions later on, about.
PART, GROUP = 16_384, 65_536
# Rounds of exchange at most; each can only lessen the sequences, so a limit costs no rows.
ROUNDS = 6
# Equal pieces that are dealt together.
COPIES = 1_024
# Chunks of text whose ids a task remembers.
HELD = 600_000

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Cuts at which the vocabulary's own pattern cuts as well: before white space, and behind Latin letters
# that no letter or digit follows. So chunks are encoded apart, and a frequent one only once.
_CHUNK = f" ?[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f]+(?!\\w)|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+"


class Ids(dict):
    """Ids of texts by a public byte-level vocabulary, as little-endian 32-bit numbers.

    Equal to those of the same vocabulary's tokenizer without special tokens: their strings in a
    text are ordinary text.
    """

    def __init__(self, path: str | None = None) -> None:
        import base64
        import re

        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                  special_tokens={})
        self.encode, self.chunks = coder.encode_ordinary, re.compile(_CHUNK).findall

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= HELD:
            self.clear()
        found = np.array(self.encode(chunk), "<u4").tobytes()
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.chunks(text)))


def pieces(documents: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents' ids with an end, cut where too long.

    All pieces of a document but its first have `capacity` ids; the first has what is left. A
    null or empty text is its end alone.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = Ids(path), np.array([END], "<u4").tobytes()
        for batch in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                data = ids.of(text) + end
                total = len(data) // 4
                at, size = 0, total % capacity or capacity
                n = 0
                while at < total:
                    of.append(k)
                    piece.append(n)
                    start.append(at)
                    length.append(size)
                    crc.append(crc32(data[4 * at:4 * (at + size)]))
                    at, size, n = at + size, capacity, n + 1
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", plain("text").alias("text")).mapInArrow(
        work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def least_sequences(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """A number of sequences that no packing of pieces of these lengths can go below.

    Dual-feasible functions map lengths so that whatever fits one sequence maps to at most 1: their
    sum is a bound. Tried are, for each threshold t up to half a sequence: pieces above capacity - t
    count 1, those below t nothing, the rest by length; and the same with lengths above half
    counting 1 and those from t up to half their share in how many of t fit; and rounding by k.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1].astype(np.int64)
    if not counts.sum():
        return 0
    sizes = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int(counts @ sizes) // capacity)
    half = capacity // 2
    for t in range(1, half + 1):
        # Whole numbers throughout: values are in parts of `top`.
        flat = np.where(sizes > capacity - t, capacity, np.where(sizes < t, 0, sizes))
        best = max(best, -(-int(counts @ flat) // capacity))
        top = capacity // t
        fits = np.where(2 * sizes > capacity, 2 * (top - (capacity - sizes) // t),
                        np.where(2 * sizes == capacity, top, 2 * (sizes // t)))
        best = max(best, -(-int(counts @ fits) // (2 * top)))
    for k in range(1, 101):
        times = (k + 1) * sizes
        # A length that k + 1 divides evenly keeps its share, others are rounded down to k-ths.
        parts = np.where(times % capacity == 0, k * sizes, times // capacity * capacity)
        best = max(best, -(-int(counts @ parts) // (k * capacity)))
    return best


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int], list[int]]:
    """Sequence and offset of every piece by best-fit decreasing, and the sequences' free places.

    `lengths` descend. Sequences lie in stacks by free places; the bits of one number tell which
    stacks are filled, so the fullest sequence that has room is found at once.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0
    free: list[int] = []
    sequence, offset = [], []
    for length in lengths:
        room = filled >> length
        if room:
            at = length + (room & -room).bit_length() - 1
            s = stacks[at].pop()
            if not stacks[at]:
                filled ^= 1 << at
        else:
            s = len(free)
            free.append(capacity)
        sequence.append(s)
        offset.append(capacity - free[s])
        free[s] -= length
        if free[s]:
            stacks[free[s]].append(s)
            filled |= 1 << free[s]
    return sequence, offset, free


_ROW = ["doc_id", "piece", "start", "length", "ids_crc32", "copy"]
_GIVEN = "part long, sequence_id long, offset long, free long, sequences long, bound long, round int, certified boolean, settled boolean"


def _repacked(rows: DataFrame, turn: int, capacity: int) -> DataFrame:
    """The rows of each part packed anew; a part whose sequences do not lessen keeps the old ones."""
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), *((c, "ascending") for c in _ROW if c != "length")])
        n, part = table.num_rows, table["part"][0].as_py()
        lengths = table["length"].to_pylist()
        sequence, offset, free = best_fit(lengths, capacity)
        bound, before = least_sequences(np.array(lengths), capacity), None
        number = (turn << 58) + (part << 24) + np.array(sequence, np.int64)
        left = np.array(free, np.int64)[sequence]
        if turn:
            before = len(set(table["sequence_id"].to_pylist()))
        certified = len(free) == bound
        if before is not None and len(free) >= before:
            certified = before == bound
            sequences, settled = before, np.ones(n, bool)
            number, offset, left = (table[c].combine_chunks() for c in ("sequence_id", "offset", "free"))
        else:
            sequences, settled = len(free), (left == 0) | certified
        return pa.table({
            **{c: table[c] for c in _ROW}, "part": pa.array([part] * n, pa.int64()),
            "sequence_id": pa.array(number, pa.int64()), "offset": pa.array(offset, pa.int64()),
            "free": pa.array(left, pa.int64()), "sequences": pa.array([sequences] * n, pa.int64()),
            "bound": pa.array([bound] * n, pa.int64()), "round": pa.array([turn] * n, pa.int32()),
            "certified": pa.array([certified] * n), "settled": pa.array(settled, pa.bool_())})

    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in _ROW)
    return rows.groupBy("part").applyInArrow(work, f"{schema}, {_GIVEN}")


def packed(cut: DataFrame, capacity: int = CAPACITY, part: int = PART, group: int = GROUP,
           rounds: int = ROUNDS) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with `sequence_id` and `offset` in it.

    Also returned: `round`, in which the sequence was closed, and `certified`, whether the
    partition it was closed in reached its bound, so that its pieces fit no fewer sequences.
    Pieces are dealt to partitions by content, equal ones in lots of COPIES, so reruns agree and
    no partition holds more than its share; null ids are an id like any other. In each round
    partitions with a gap, whole, meet in groups of about `group` open pieces. Stops when
    all are certified, when no group lessened its sequences, or after `rounds`. The driver
    sees counts alone. An empty table gives an empty one.
    """
    cut = cut.select(*(c for c in _ROW if c != "copy"))
    total = cut.count()
    copies = cut.groupBy(*cut.columns).agg(F.count("*").alias("_n")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("_n")
    lot = F.floor(F.col("copy") / COPIES)
    dealt = F.pmod(F.xxhash64(*cut.columns, lot), F.lit(max(1, -(-total // part))))
    done = []
    rows = copies.withColumn("part", dealt)
    for turn in range(rounds + 1):
        now = written(_repacked(rows, turn, capacity), "packing")
        open_rows = now.filter("not settled")
        left, parts = open_rows.agg(F.count("*"), F.count_distinct("part")).first()
        if parts < 2 or turn == rounds:
            done.append(now)
            break
        done.append(now.filter("settled"))
        groups = max(1, min(parts // 2, -(-left // group)))
        rows = open_rows.withColumn("part", F.pmod(F.xxhash64("part", F.lit(turn)), F.lit(groups)))
    return reduce(DataFrame.unionByName, done).select(
        *cut.columns, "sequence_id", "offset", "round", "certified")


def report(found: DataFrame) -> DataFrame:
    """Per round: closed sequences, their pieces and ids, and how many are certified."""
    each = found.groupBy("round", "sequence_id").agg(
        F.count("*").alias("n"), F.sum("length").alias("ids"), F.max("certified").alias("sure"))
    return each.groupBy("round").agg(
        F.count("*").alias("sequences"), F.sum("n").alias("pieces"), F.sum("ids").alias("ids"),
        F.count_if("sure").alias("certified"))
