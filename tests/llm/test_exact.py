"""Decontamination, sharding and mixing on hostile small tables."""

import itertools

from pyspark.sql import functions as F

from depotline.llm import decontamination, mixing, sharding

LONG = " ".join(f"b{i}" for i in range(30))


def test_windows_short_items_and_nulls(spark):
    items = spark.createDataFrame(
        [(1, LONG), (2, "alpha Beta"), (3, None), (4, "..."), (1, LONG), (None, "solo")],
        "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x " + " ".join(LONG.split()[5:20]) + " y"), (2, "ALPHA, beta! z"), (3, None), (4, ""),
         (5, " ".join(LONG.split()[:12])), (6, "the solo word"), (2, "ALPHA, beta! z")],
        "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.items) for r in
                 decontamination.judged(docs, items).collect())
    assert got == [(1, 17, 15, ["1"]), (2, 3, 2, ["2"]), (2, 3, 2, ["2"]), (3, 0, 0, []), (4, 0, 0, []),
                   (5, 12, 0, []), (6, 3, 1, [""])]


def test_clean_keeps_own_columns(spark):
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    docs = spark.createDataFrame([(1, LONG, 9, "k"), (2, "fine", 8, "k"), (3, None, 7, "k")],
                                 "doc_id long, text string, n_hit int, _key string")
    kept = decontamination.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_permutation_is_a_bijection_and_shards_are_even(spark):
    for total in (1, 2, 5, 17, 1_000):
        rows = spark.range(total).select(
            sharding.shuffled_number(F.col("id"), total, 7).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(total))
    frame = spark.range(103).select(F.col("id").alias("doc_id"), F.lit("t").alias("shard"))
    first = sharding.sharded(frame, [F.col("doc_id")]).collect()
    again = sharding.sharded(frame.repartition(7), [F.col("doc_id")]).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    for _, some in itertools.groupby(sorted(first, key=lambda r: r.shard), key=lambda r: r.shard):
        slots = sorted(r.slot for r in some)
        assert slots == list(range(len(slots))) and len(slots) in (6, 7)
    assert sharding.sharded(frame.limit(0), [F.col("doc_id")]).count() == 0


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, out, open_names = float(sum(sizes.values())), {}, list(names)
    while open_names:
        level = left / sum(weight[s] for s in open_names)
        above = [s for s in open_names if level * weight[s] > 3 * sizes[s]]
        if not above:
            return out | {s: level * weight[s] for s in open_names}
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_names.remove(s)
    return out


def test_mixing_meets_targets(spark):
    rows = [(i, s, i % 7 + 1) for s, n in (("a", 300), ("b", 5), (None, 40), ("c", 3)) for i in range(n)]
    rows += [(i, "empty", 0) for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    by = [F.col("doc_id")]
    got = mixing.copies(frame, "source", "size", by).collect()
    again = mixing.copies(frame.repartition(5), "source", "size", by).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = _targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert abs(own[0].target - want[s]) < 1e-6
        assert abs(sum(r.copies * r.size for r in own) - want[s]) <= 7
        assert all(0 <= r.copies <= 3 for r in own)
    assert mixing.copies(frame.limit(0), "source", "size", by).count() == 0


def test_mixing_comes_near_targets_where_one_document_is_large(spark):
    """The large document of a source is made up for by its small ones, within the smallest's size."""
    rows = [(0, "a", 5_000)] + [(i, "a", i % 9 + 3) for i in range(1, 400)]
    rows += [(1_000 + i, f"s{i % 11}", (i * 37) % 90 + 1) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.copies(frame, "source", "size", [F.col("doc_id")]).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= min(r.size for r in own)
        assert all(0 <= r.copies <= 3 for r in own)


def test_mixing_of_many_sources_and_clashing_names(spark):
    rows = [(i, f"host{i % 400:03d}" if i % 400 else None, i % 13 + 1, "x", 7) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long, tree string, weight int")
    got = mixing.copies(frame, "source", "size", [F.col("doc_id")]).collect()
    sizes = {}
    for _, s, n, _, _ in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = _targets(sizes)
    assert len(got) == 2_000 and all(abs(r.target - want[r.source]) < 1e-6 for r in got)
    assert {(r.tree, r.weight) for r in got} == {("x", 7)}


def test_mixed_rows_keep_their_columns(spark):
    rows = [(i % 50, f"word {i % 7} " * (i % 5), "s" + str(i % 3), "k", 5) for i in range(300)]
    rows += [(None, None, None, None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, _key string, size long")
    found = mixing.mixed(frame)
    assert found.columns == frame.columns
    assert {tuple(r) for r in found.collect()} <= set(rows)
    assert mixing.mixed(frame.limit(0)).count() == 0
