"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.llm.common import fresh, lower_ascii, plain
from depotline.session import written

# Words of a contract's window, of a fingerprint's k-gram, and k-grams of which the least counts.
# A shared span of SPAN words holds WINDOW k-grams, so both sides keep the same least one.
SPAN, GRAM = 13, 5
WINDOW = SPAN - GRAM + 1
REACH = SPAN - GRAM
# Everything between words: ASCII but for digits and letters. Capitals count as letters here,
# as words are cut first and put in lower case afterwards.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Fingerprints of the test side up to which they are broadcast (each is below 300 bytes);
# beyond that both sides are shuffled by fingerprint.
BROADCAST_ROWS = 200_000
LOW = (1 << 32) - 1


def word_hashes(text: str) -> Column:
    """Hash of every word, A-Z in lower case; an empty array for null."""
    words = F.array_remove(F.split(plain(text), BETWEEN), "")
    return F.transform(words, lambda w: F.xxhash64(lower_ascii(w)))


def _at(hashes: str, first: Column, count: int) -> list[Column]:
    return [F.get(F.col(hashes), first + i) for i in range(count)]


def winnowed(rows: DataFrame, hashes: str, keep: list[str]) -> DataFrame:
    """Fingerprints of word-hash arrays of SPAN words or more: one row per kept k-gram.

    `at` is the k-gram's first word, `gram` its hash, `before` and `after` are the up to REACH
    word hashes on its sides: every window of SPAN words around the k-gram lies inside.
    """
    # Hash above, place below: the least of a window names its leftmost least k-gram.
    marked = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - GRAM),
        lambda i: F.shiftleft(F.hash(*_at(hashes, i, GRAM)).cast("long"), 32).bitwiseOR(
            i.cast("long")))
    least = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("_marked") - WINDOW + 1),
        lambda i: F.array_min(F.slice("_marked", i, WINDOW))))
    long_enough = rows.filter(F.size(hashes) >= SPAN)
    found = (long_enough.select(*keep, hashes, marked.alias("_marked"))
             .select(*keep, hashes, least.alias("_kept"))
             .select(*keep, F.explode(F.transform("_kept", lambda m: _print(hashes, m)))
                     .alias("_print")))
    return found.select(*keep, "_print.*")


def _print(hashes: str, mark: Column) -> Column:
    at = mark.bitwiseAND(F.lit(LOW)).cast("int")
    start = F.greatest(at - REACH, F.lit(0))
    return F.struct(at.alias("at"), F.xxhash64(*_at(hashes, at, GRAM)).alias("gram"),
                    F.slice(hashes, start + 1, at - start).alias("before"),
                    F.slice(hashes, at + GRAM + 1, REACH).alias("after"))


def _same_run(mine: Column, other: Column) -> Column:
    """How many leading elements of two arrays agree."""
    differs = F.array_position(F.zip_with(mine, other, lambda a, b: F.coalesce(a == b, F.lit(False))),
                               False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(mine), F.size(other))).cast("int")


def _either(small: DataFrame) -> DataFrame:
    """The small side, broadcast where its counted rows allow it."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def hits(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Spans of `documents` (key, hashes) that hold windows of `items` (item, hashes).

    One row per document key, item and span of words [first, last]. A window is SPAN words of
    an item, or a shorter item as a whole.
    """
    ours = winnowed(documents, "hashes", ["key"])
    theirs = winnowed(items, "hashes", ["item"]).select(
        "item", "gram", F.col("before").alias("_before"), F.col("after").alias("_after"))
    met = ours.join(_either(theirs.distinct()), "gram")
    left = _same_run(F.reverse("before"), F.reverse("_before"))
    right = _same_run(F.col("after"), F.col("_after"))
    spans = (met.select("key", "item", "at", left.alias("_l"), right.alias("_r"))
             .filter(F.col("_l") + F.col("_r") + GRAM >= SPAN)
             .select("key", "item", (F.col("at") - F.col("_l")).alias("first"),
                     (F.col("at") + GRAM - 1 + F.col("_r")).alias("last")))

    # Items below SPAN words match as a whole, found by their first word.
    short = (items.filter((F.size("hashes") > 0) & (F.size("hashes") < SPAN))
             .select("item", F.col("hashes").alias("_whole"), F.get("hashes", F.lit(0)).alias("word"))
             .distinct())
    if short.isEmpty():
        return spans
    words = documents.select("key", F.explode(F.transform("hashes", lambda h, i: F.struct(
        h.alias("word"), i.alias("first"), F.slice("hashes", i + 1, SPAN - 1).alias("_next"))))
        .alias("_w")).select("key", "_w.*")
    size = F.size("_whole")
    matched = (words.join(_either(short), "word")
               .filter(F.slice("_next", F.lit(1), size) == F.col("_whole"))
               .select("key", "item", "first", (F.col("first") + size - 1).alias("last")))
    return spans.unionByName(matched)


def contamination(documents: DataFrame, items: DataFrame, text: str = "text",
                  item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per text of the documents that holds a window of an item.

    Returns key (md5 of the text, empty for null), n_hit (words inside any window), n_items,
    items (ids as strings, sorted). Texts are matched once by content, so that copies meet in
    the aggregates before the shuffle. A null id counts as an empty string; null and
    wordless texts and items match nothing; a repeated item counts once.
    """
    ours = documents.select(F.md5(plain(text)).alias("key"), word_hashes(text).alias("hashes"))
    theirs = items.select(plain(F.col(item_id).cast("string")).alias("item"),
                          word_hashes(item_text).alias("hashes"))
    # Written, as both aggregates read it and the search must run once.
    found = written(hits(ours, theirs).distinct(), "decontamination")
    words = (found.select("key", F.explode(F.sequence("first", "last")).alias("_word")).distinct()
             .groupBy("key").agg(F.count("*").alias("n_hit")))
    named = (found.select("key", "item").distinct().groupBy("key")
             .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_set("item")).alias("items")))
    return words.join(named, "key")


def judged(documents: DataFrame, items: DataFrame, share: int = 20, text: str = "text",
           item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents with n_words, n_hit, n_items, items and contaminated.

    A document is contaminated if at least one word in `share` lies inside a window. Every
    row is returned, equal rows with equal verdicts. Columns of these names are replaced.
    """
    base = documents.drop("n_words", "n_hit", "n_items", "items", "contaminated", "_key")
    found = contamination(documents, items, text, item_text, item_id)
    n_words = F.size(F.array_remove(F.split(plain(text), BETWEEN), "")).cast("long")
    # Counted before the join, so that a caller who needs no text moves none.
    joined = (base.withColumn("n_words", n_words).withColumn("_key", F.md5(plain(text)))
              .join(found.withColumnRenamed("key", "_key"), "_key", "left").drop("_key"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return (joined.withColumn("n_hit", n_hit)
            .withColumn("n_items", F.coalesce(F.col("n_items"), F.lit(0)).cast("long"))
            .withColumn("items", F.coalesce(F.col("items"), F.array().cast("array<string>")))
            .withColumn("contaminated",
                        (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))


def clean(documents: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with their own columns and no others."""
    key, = fresh(documents, "_key")
    found = contamination(documents, items)
    words = F.size(F.array_remove(F.split(plain("text"), BETWEEN), ""))
    bad = found.select(F.col("key").alias(key), F.col("n_hit").alias("_bad"))
    hit, = fresh(documents, "_hit")
    joined = documents.withColumn(key, F.md5(plain("text"))).join(
        bad.withColumnRenamed("_bad", hit), key, "left")
    return joined.filter(F.col(hit).isNull() | (share * F.col(hit) < words)).select(
        *documents.columns)
