"""Spelling variants: words one edit apart, found by walking a trie that is a distributed table.

The trie of all words is a table of edges (node, label, child). A frontier of states (word,
position, node, edits) is joined with it level by level: an edge whose label the word goes on
with is followed, and one that fits but for a single replaced or added letter spends the one
edit. States that end on a word with one edit spent are neighbours.

An edit leaves either the first or the second half of a word whole. So words are walked forwards
and backwards, each time from the node behind the half that stays whole, where few edges leave a
node; no walk starts at the root. Chains of nodes without a branch are one edge, so a long word
takes no more levels than it has branches.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotline.llm.similar import mixed
from depotline.session import written

LEAST_CHARS, LEAST_COUNT = 5, 3
# One run in so many, by its hash with its document's id, is misspelt on purpose by the contract.
SPOILT = 97
# Words that a task counts before it hands them on.
HELD = 200_000
# Lengths that a node's mask tells apart; its last bit stands for all longer ones.
MASK = 62
_RUN = re.compile("[a-z\\xc0-\\xff]+")


def runs(text: str | None) -> list[str]:
    """Runs of letters, A-Z in lower case."""
    return _RUN.findall((text or "").encode("utf-8", "replace").lower().decode())


def spoilt(run: str, seed: int) -> str:
    """The run, or where the hash says so, the run without one of its letters."""
    h = crc32(run.encode(), seed)
    if h % SPOILT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(documents: DataFrame) -> DataFrame:
    """(word, n) of rows (doc_id, text): what runs become, if long enough and met often enough.

    A null text has no runs; a null id counts as empty text. Words are counted in the tasks
    before they are dealt, so a frequent one is a row per task.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(held), pa.string()),
                                   pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                    strict=True):
                seed = crc32(f"{doc_id or ''}:".encode())
                for run, n in Counter(runs(text)).items():
                    word = spoilt(run, seed)
                    if len(word) >= LEAST_CHARS:
                        held[word] += n
                if len(held) > HELD:
                    yield handed()
        if held:
            yield handed()

    return (documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
            .mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


def _node_rows(words: list[tuple[int, str]], backwards: bool) -> list[np.ndarray]:
    """id, at, node, next letter (-1 at the end) and letters left, for each place from the middle on.

    A node is the hash of the letters before the place; all words advance by one letter at once.
    """
    some = sorted(((w[::-1] if backwards else w, i) for i, w in words), key=lambda x: -len(x[0]))
    sizes = np.array([len(w) for w, _ in some])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    letters = np.frombuffer("".join(w for w, _ in some).encode("utf-32-le"), "<u4").astype(np.uint64)
    ids = np.array([i for _, i in some], np.int64)
    node = np.full(len(some), 2 if backwards else 1, np.uint64)
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    alive = len(some)
    for at in range(int(sizes[0]) + 1):
        alive = int(np.searchsorted(-sizes[:alive], -at, side="right"))
        here = np.flatnonzero((sizes[:alive] - 1) // 2 <= at)
        on = at < sizes[:alive]
        letter = np.full(alive, -1, np.int64)
        letter[on] = letters[starts[:alive][on] + at].astype(np.int64)
        for column, values in zip(out, (ids[here], np.full(len(here), at), node[here].view(np.int64),
                                        letter[here], sizes[here] - at), strict=True):
            column.append(values)
        step = np.flatnonzero(on)
        node[step] = mixed(node[step] * np.uint64(0x100000001B3) + letters[starts[step] + at] + np.uint64(1))
    return [np.concatenate(c) for c in out]


def _places(words: DataFrame) -> DataFrame:
    """(id, back, at, node, next, left): the nodes of every word, forwards and backwards."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = list(zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True))
            for back in (False, True):
                if some:
                    columns = _node_rows(some, back)
                    n = len(columns[0])
                    yield pa.record_batch(
                        [pa.array(columns[0]), pa.array(np.full(n, back)), pa.array(columns[1], pa.int32()),
                         pa.array(columns[2]), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32())],
                        names=["id", "back", "at", "node", "next", "left"])

    return words.select("id", "word").mapInArrow(
        work, "id long, back boolean, at int, node long, next int, left int")


def _bit(length: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.least(length, F.lit(MASK)))


def _letter_bit(letter: Column) -> Column:
    """A bit for a letter; two letters may share one."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), letter % F.lit(63))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (node, label, child, word, mask, letters) and first states (id, node, rest, edits) of
    words (id, word).

    Nodes are kept where the words through them part, where one ends, and where walks start.
    `word` is the id of the word that ends on the child; bit k of `mask` tells that a
    word ends k letters below the child, the bits of `letters` with which letters it goes on.
    Both are written tables.
    """
    size = F.col("at") + F.col("left")
    # The half that stays whole: the first of a word forwards, the second, rounded up, backwards.
    half = F.floor((size + F.col("back").cast("int")) / 2)
    through = Window.partitionBy("node")
    parts = F.min("next").over(through) != F.max("next").over(through)
    starts = F.col("at") == half
    kept = (_places(words).withColumn("start", starts)
            .withColumn("_kept", parts | (F.min("next").over(through) == -1) | F.max("start").over(through))
            .withColumn("mask", F.bit_or(_bit(F.col("left"))).over(through))
            .withColumn("letters", F.coalesce(F.bit_or(F.when(
                F.col("next") >= 0, _letter_bit(F.col("next")))).over(through), F.lit(0).cast("long")))
            .filter("_kept"))
    along = Window.partitionBy("id", "back").orderBy("at")
    steps = kept.select(
        "id", "back", "at", "node", "start",
        *(F.lead(c).over(along).alias(f"_{c}") for c in ("at", "node", "left", "mask", "letters")))
    spelt = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    # One row per kept node and word, with the letters behind the node.
    whole = written(steps.join(words.select("id", "word"), "id").select(
        "id", "node", "start", F.expr("_node").alias("child"), F.col("_mask").alias("mask"),
        F.col("_letters").alias("letters"), (F.col("_left") == 0).alias("ends"), F.substring(spelt, F.col("at") + 1, F.length(spelt)).alias("rest"),
        (F.col("_at") - F.col("at")).alias("length")), "trie-steps")
    edges = whole.filter("child IS NOT NULL").groupBy(
        "node", "child", F.substring("rest", F.lit(1), F.col("length")).alias("label")).agg(
        F.max(F.when(F.col("ends"), F.col("id"))).alias("word"), F.first("mask").alias("mask"),
        F.first("letters").alias("letters"))
    first = whole.filter("start").select("id", "node", "rest", F.lit(0).alias("edits"))
    return written(edges, "trie-edges"), first


def _after(rest: Column, letters: Column) -> Column:
    """The rest of a text behind so many letters."""
    return F.substring(rest, letters + 1, F.length(rest))


def frontier(edges: DataFrame, states: DataFrame) -> DataFrame:
    """Pairs (a, b) of word ids: b is a with one letter added, or replaced by a greater one.

    So each pair of words is looked for from one of them only. A state whose edit is spent goes on
    only where a word of its length follows, and one with its next letter.

    Each level is a written table of the states that go on and those that have ended; counts tell
    the driver when no state is left.
    """
    rest, label = F.col("rest"), F.col("label")
    size = F.length(label)
    same = F.startswith(rest, label)
    # How many letters of a label that does not fit the word agree; mostly not even the first.
    agree = F.when(F.substring(rest, F.lit(1), F.lit(1)) != F.substring(label, F.lit(1), F.lit(1)), 0).when(
        F.length(rest) == 0, 0).otherwise(F.array_position(F.zip_with(
            F.split(label, ""), F.split(F.substring(rest, F.lit(1), size), ""),
            lambda x, y: ~x.eqNullSafe(y)), True).cast("int") - 1)
    tail = _after(label, F.col("_agree") + 1)
    unspent = (F.col("edits") == 0) & ~F.col("_same")
    replaced = unspent & (F.substring(rest, F.col("_agree") + 1, F.lit(1)) < F.substring(
        label, F.col("_agree") + 1, F.lit(1))) & (F.length(rest) > F.col("_agree")) & F.startswith(
        _after(rest, F.col("_agree") + 1), tail)
    added = unspent & F.startswith(_after(rest, F.col("_agree")), tail)
    pairs = []
    states = written(states, "trie-states")
    while not states.isEmpty():
        met = (states.join(edges, "node").withColumn("_same", same)
               .filter((F.col("edits") == 0) | F.col("_same"))
               .withColumn("_agree", F.when(F.col("_same"), 0).otherwise(agree)))
        outcomes = F.array_compact(F.array(
            F.when(F.col("_same"), F.struct(_after(rest, size).alias("rest"), F.col("edits").alias("edits"))),
            F.when(replaced, F.struct(_after(rest, size).alias("rest"), F.lit(1).alias("edits"))),
            F.when(added, F.struct(_after(rest, size - 1).alias("rest"), F.lit(1).alias("edits")))))
        reached = met.select("id", "child", "word", "mask", "letters", F.explode(outcomes).alias("_now")).select(
            "id", F.col("child").alias("node"), "word", "mask", "letters", "_now.rest", "_now.edits")
        done = (F.col("edits") == 1) & (F.length("rest") == 0)
        onward = (F.length("rest") == 0) | (_letter_bit(F.ascii("rest")).bitwiseAND(F.col("letters")) != 0)
        alive = (F.col("edits") == 0) | ((_bit(F.length("rest")).bitwiseAND(F.col("mask")) != 0) & onward)
        level = written(reached.filter(alive & (~done | F.col("word").isNotNull())).select(
            "id", "node", "rest", "edits", F.when(done, F.col("word")).alias("found")), "trie-states")
        pairs.append(level.filter("found IS NOT NULL").select(F.col("id").alias("a"), F.col("found").alias("b")))
        states = level.filter("found IS NULL").drop("found")
    found = pairs[0] if pairs else states.select(F.col("id").alias("a"), F.col("id").alias("b"))
    for more in pairs[1:]:
        found = found.union(more)
    return found.distinct()


def one_edit(a: str, b: str) -> bool:
    """Whether b is a with exactly one letter replaced, added or taken out."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def _checked(pairs: DataFrame) -> DataFrame:
    """Pairs whose words are truly one edit apart; nodes are hashes, which could be equal by chance."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [one_edit(x, y) for x, y in zip(batch.column("word").to_pylist(),
                                                   batch.column("near").to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(work, pairs.schema)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) both ways for all words (id, word, n) that are one edit apart.

    Words are different from each other; ids tell them apart.
    """
    edges, first = trie(words)
    pairs = frontier(edges, first)
    left = words.select(F.col("id").alias("a"), "word", "n")
    right = words.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = _checked(pairs.join(left, "a").join(right, "b").select("word", "n", "near", "near_n"))
    # Each pair was found from one side.
    return found.union(found.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
        F.col("n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words (word, form) that have a form: where following forms ends.

    Every round doubles the forms that are followed at once. A form is met at least twice as often
    as its word, so the rounds are few: the logarithm of the logarithm of the largest count.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = written(now.join(onward, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "roots")
        now = longer.drop("_moved")
        if longer.filter("_moved").isEmpty():
            return now


def variants(documents: DataFrame) -> DataFrame:
    """Every word of the documents (doc_id, text) with its form and root.

    Returned: word, form, root (string), n, n_near, form_n (long). A word's form is the one of its
    neighbours that is met most often (ties: the least in code-point order), if that is at least
    twice as often as the word; else null. The root is where forms lead, the word itself if
    none. Repeated rows count each time. An empty table, or one without such words, gives none.
    """
    words = written(vocabulary(documents).withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(words)
    best = F.min_by(F.struct(F.col("near").alias("form"), F.col("near_n").alias("form_n")),
                    F.struct(-F.col("near_n"), F.col("near")))
    folded = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    joined = words.join(folded, "word", "left")
    known = F.col("_best.form_n") >= 2 * F.col("n")
    found = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(known, F.col("_best.form")).alias("form"), F.when(known, F.col("_best.form_n")).alias("form_n")),
        "forms")
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
