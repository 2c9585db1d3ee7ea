"""Links between similar texts: banded signatures, few comparisons per bucket, exact check.

The signatures come from the caller; candidates, the exact Jaccard check and the components
are the same for whole documents and for paragraphs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.llm.components import components
from depotline.llm.words import in_turn, parsed
from depotline.session import written

SHINGLE = 5
# Rounds in which buckets check their texts with one of them, at most.
ROUNDS = 3
# Texts of a bucket in one block of the check of all pairs.
BLOCK = 400
# Words, or shingles, that are worked off at once.
HELD = 200_000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of words, remembered up to a number of words."""

    def __init__(self, most: int = 300_000) -> None:
        self.known: dict[bytes, int] = {}
        self.most = most

    def of(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: list[bytes], hashes: Words) -> np.ndarray:
    """Hash of every run of SHINGLE words, in order; all words are one where they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    return shingled(hashes.of(words))


def shingled(h: np.ndarray) -> np.ndarray:
    """Hash of every run of SHINGLE of the words whose hashes are given."""
    size = min(SHINGLE, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        out = mixed(out + h[i:len(h) - size + 1 + i] + _GOLD)
    return out


def runs_of(h: np.ndarray, grams: np.ndarray, low: np.ndarray,
            high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of every run of words from `low` to `high`, one run after the other, and how
    many each has, none being empty; `grams` holds those that start at each word, `h` the words'
    hashes."""
    n = high - low
    count = np.maximum(n - SHINGLE + 1, 1)
    heads = np.cumsum(count) - count
    values = grams[np.arange(count.sum()) + np.repeat(low - heads, count)]
    few = np.flatnonzero(n < SHINGLE)
    single = np.zeros(len(few), np.uint64)
    for i in range(SHINGLE - 1):
        more = n[few] > i
        single[more] = mixed(single[more] + h[low[few[more]] + i] + _GOLD)
    values[heads[few]] = single
    return values, count


def sorted_runs(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The values with every run of them, of `count` each, in ascending order."""
    heads = np.cumsum(count) - count
    out = np.empty_like(values)
    width = 1
    while len(count) and width < 2 * count.max():
        mine = np.flatnonzero((count <= width) & (count > width // 2))
        if len(mine):
            inside = np.arange(width) < count[mine][:, None]
            at = (heads[mine][:, None] + np.arange(width))[inside]
            rows = np.full(inside.shape, np.iinfo(values.dtype).max, values.dtype)
            rows[inside] = values[at]
            rows.sort(axis=1)
            out[at] = rows[inside]
        width *= 2
    return out


def shingles_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of every text in order, one text after the other, and how many each has."""
    words = parsed(texts)
    h = words.hashes()
    grams = np.zeros(len(h), np.uint64)
    if len(h) >= SHINGLE:
        grams[:len(h) - SHINGLE + 1] = shingled(h)
    some = np.flatnonzero(np.diff(words.words))
    values, found = runs_of(h, grams, words.words[some], words.words[some + 1])
    count = np.zeros(len(texts), np.int64)
    count[some] = found
    return values, count


def _sets_of(texts: pa.Array) -> pa.Array:
    """Sorted different shingles of every text."""
    values, count = shingles_of(texts)
    of = np.repeat(np.arange(len(texts)), count)
    values = sorted_runs(values, count)
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    stops = np.cumsum(np.bincount(of[new], minlength=len(texts)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()),
                                    pa.array(values[new].view(np.int64)))


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(id, grams: sorted distinct shingle hashes) of rows (id, text)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_turn(batch):
                yield pa.record_batch([part.column("id"), _sets_of(part.column("text"))], names=["id", "grams"])

    return rows.select("id", "text").mapInArrow(work, "id long, grams array<long>")


def _alike(left: pa.Array, right: pa.Array, rows: np.ndarray, least: float) -> np.ndarray:
    """In which of the rows the two sets, each in order, are similar."""
    some = pa.array(rows, pa.int32())
    x, y = left.take(some), right.take(some)
    sizes = [side.value_lengths().to_numpy().astype(np.int64) for side in (x, y)]
    both = sizes[0] + sizes[1]
    heads = np.cumsum(both) - both
    values = np.empty(both.sum(), np.int64)
    for side, size, first in zip((x, y), sizes, (heads, heads + sizes[0]), strict=True):
        values[np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)] = side.flatten().to_numpy()
    values = sorted_runs(values, both)
    of = np.repeat(np.arange(len(rows)), both)
    twice = (values[1:] == values[:-1]) & (of[1:] == of[:-1])
    same = np.bincount(of[1:][twice], minlength=len(rows))
    return same >= least * (both - same)


def _overlaps(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of at least `least`."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("x"), batch.column("y")
            sizes = np.array([*map(len, left)]), np.array([*map(len, right)])
            near = np.flatnonzero((np.minimum(*sizes) >= least * np.maximum(*sizes)) & (sizes[0] > 0))
            for part in np.split(near, np.flatnonzero(np.diff(np.cumsum(sum(sizes)[near]) // HELD)) + 1):
                kept = pa.array(part[_alike(left, right, part, least)], pa.int32())
                yield pa.record_batch([batch.column("a").take(kept), batch.column("b").take(kept)],
                                      names=["a", "b"])

    return pairs.mapInArrow(work, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, least: float, purpose: str) -> DataFrame:
    """The candidate pairs (a, b) that hold, as a written table."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("y"))
    return written(_overlaps(pairs.join(left, "a").join(right, "b"), least), purpose)


def _across(rows: DataFrame, sets: DataFrame, least: float, purpose: str) -> DataFrame:
    """Links (a, b) between texts of one bucket and different classes, all of them checked.

    A bucket's texts are dealt into blocks of about BLOCK by hash, and every pair of blocks is a
    group: a task holds two blocks, however large the bucket, and no pair becomes a row unless
    it is a link.
    """
    sizes = rows.groupBy("band").agg(F.count("*").alias("_n"))
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    dealt = (rows.join(sizes, "band").withColumn("_blocks", blocks)
             .withColumn("_own", F.pmod(F.xxhash64("id", F.lit(1)), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .select("band", "id", "class", "_own", F.least("_own", "_other").alias("_i"),
                     F.greatest("_own", "_other").alias("_j"))
             .join(sets, "id"))

    def work(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        classes = table["class"].to_numpy()
        own = table["_own"].to_numpy()
        lists = table["grams"].combine_chunks()
        offsets = np.asarray(lists.offsets)
        flat = lists.values.to_numpy()
        lengths = np.diff(offsets)
        a, b = [], []
        inner = table["_i"][0].as_py() == table["_j"][0].as_py()
        for k in range(len(ids)):
            mine = flat[offsets[k]:offsets[k + 1]]
            # Each pair once: within a block by id, between blocks from the first one.
            if not len(mine) or (not inner and own[k] != table["_i"][0].as_py()):
                continue
            other = (classes != classes[k]) & (lengths > 0) & (
                (ids < ids[k]) if inner else (own != own[k]))
            other &= (lengths >= least * len(mine)) & (least * lengths <= len(mine))
            at = np.flatnonzero(other)
            if not len(at):
                continue
            theirs = np.concatenate([flat[offsets[i]:offsets[i + 1]] for i in at])
            place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            starts = np.concatenate([[0], np.cumsum(lengths[at])[:-1]])
            same = np.add.reduceat((mine[place] == theirs).astype(np.int64), starts)
            hit = at[same >= least * (len(mine) + lengths[at] - same)]
            a += [ids[k]] * len(hit)
            b += ids[hit].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return written(dealt.groupBy("band", "_i", "_j").applyInArrow(work, "a long, b long").distinct(),
                   purpose)


def _open_buckets(crowded: DataFrame, classes: DataFrame | None, purpose: str) -> DataFrame:
    """(band, id, class) of the buckets whose texts lie in more than one class."""
    classed = crowded.withColumn("class", F.col("id")) if classes is None else crowded.join(
        classes.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "id", F.coalesce("component", "id").alias("class"))
    mixed_up = (classed.groupBy("band").agg(F.min("class").alias("x"), F.max("class").alias("y"))
                .filter("x <> y").select("band"))
    return written(classed.join(mixed_up, "band"), purpose)


def _pairs_left(rows: DataFrame) -> tuple[int, int]:
    """How many pairs of different classes the buckets hold, and how many rows."""
    per_class = rows.groupBy("band", "class").agg(F.count("*").cast("double").alias("n"))
    per_band = per_class.groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") ** 2).alias("s"))
    row = per_band.agg(F.sum((F.col("n") ** 2 - F.col("s")) / 2), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)


def linked(bands: DataFrame, texts: DataFrame, least: float, purpose: str) -> DataFrame:
    """Classes of similar texts: (node, component) of every text that has a link.

    `bands` holds (band, id): a bucket and a text; `texts` holds (id, text), equal rows allowed.
    In each round every bucket names one of its texts, by a hash of text, bucket and round;
    the texts of other classes are checked with it, and what holds joins classes. Buckets whose
    texts all lie in one class are done, however large. Rounds go on while they are
    cheaper than what they may save: until the buckets hold no more pairs across classes
    than rows, or ROUNDS are over. Then all pairs across classes are checked. So no candidate
    link between classes is left out; links inside a class cannot change the classes.
    """
    bands = bands.repartition("band")  # one shuffle serves the sums and the join
    shared = (bands.groupBy("band").agg(F.min("id").alias("_low"), F.max("id").alias("_top"))
              .filter("_low <> _top").select("band"))
    crowded = written(bands.join(shared, "band"), purpose)
    ids = crowded.select("id").distinct()
    # One text per id: copies fold in the tasks, before anything is dealt by id.
    single = texts.groupBy("id").agg(F.first("text").alias("text"))
    sets = written(shingle_sets(single.join(ids, "id", "left_semi")), purpose)
    links, classes = None, None
    for turn in range(ROUNDS + 1):
        rows = _open_buckets(crowded, classes, purpose)
        pairs, size = _pairs_left(rows)
        if not pairs:
            break
        last = turn == ROUNDS or (turn and pairs <= size)
        if last:
            new = _across(rows, sets, least, purpose)
        else:
            drawn = F.xxhash64("id", "band", F.lit(turn))
            named = rows.groupBy("band").agg(F.min(F.struct(drawn.alias("h"), "id", "class")).alias("_rep"))
            met = rows.join(named, "band").filter(F.col("class") != F.col("_rep.class"))
            found = met.select(F.greatest("id", "_rep.id").alias("a"), F.least("id", "_rep.id").alias("b"))
            new = _verified(found.distinct(), sets, least, purpose)
        links = new if links is None else links.union(new)
        classes = written(components(links), purpose)
        if last:
            break
    if classes is None:
        return crowded.select(F.col("id").alias("node"), F.col("id").alias("component")).limit(0)
    return classes
