from collections import Counter

from pyspark.sql import functions as F

from depotline.operators import aggregates, joins, sampling


def test_numbering_is_dense_though_one_group_is_hot(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") < 2000, "hot").otherwise(
            F.concat(F.lit("g"), (F.col("id") / 100).cast("int"))).alias("g"))
    got = joins.numbered(rows, "g", "id", "seat").groupBy("g").agg(
        F.count("*").alias("n"), F.min("seat").alias("low"), F.max("seat").alias("high"),
        F.count_distinct("seat").alias("d"))
    for r in got.collect():
        assert (r.low, r.high, r.d) == (0, r.n - 1, r.n)


def test_match_stays_in_the_group_and_falls_back(spark):
    left = spark.range(900).select(
        "id", F.when(F.col("id") < 600, "hot").when(F.col("id") < 800, "b")
        .when(F.col("id") < 890, "none").alias("g"))
    people = spark.range(1000, 1300).select(
        F.col("id").alias("person"), F.when(F.col("id") < 1200, "hot").otherwise("b").alias("g"))
    got = joins.match_in_group(left, people, "id", "person", "g").collect()
    assert Counter(r.id for r in got) == Counter(range(900))
    for r in got:
        if r.g == "hot":
            assert 1000 <= r.person < 1200
        elif r.g == "b":
            assert 1200 <= r.person < 1300
        else:
            assert 1000 <= r.person < 1300
    again = {r.id: r.person for r in joins.match_in_group(left, people, "id", "person", "g").collect()}
    assert again == {r.id: r.person for r in got}
    assert len({r.person for r in got if r.g == "hot"}) > 150


def test_match_without_candidates(spark):
    left = spark.range(3).select("id", F.lit("x").alias("g"))
    none = spark.createDataFrame([], "person LONG, g STRING")
    got = joins.match_in_group(left, none, "id", "person", "g").collect()
    assert [r.person for r in got] == [None, None, None]


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id INT, parent INT")
    parent = spark.createDataFrame([(10,), (10,)], "key INT")
    assert [r.id for r in joins.orphans(child, "parent", parent, "key").collect()] == [2]
    assert [r.key for r in joins.without_children(
        spark.createDataFrame([(10,), (11,)], "key INT"), "key", child, "parent").collect()] == [11]


def test_total_mismatch_by_a_cent(spark):
    parent = spark.createDataFrame([(1, 10), (2, 10), (3, 0)], "id INT, c INT").select(
        "id", (F.col("c") / 1).cast("decimal(12,2)").alias("total"))
    child = spark.createDataFrame([(1, "4.00"), (1, "6.00"), (2, "9.99"), (9, "1.00")],
                                  "id INT, a STRING").select(
        F.col("id").alias("parent"), F.col("a").cast("decimal(12,2)").alias("amount"))
    got = aggregates.total_mismatch(parent, "id", "total", child, "parent", "amount").collect()
    assert [r.id for r in got] == [2]


def test_total_lookup_keeps_parents_without_children(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id INT")
    child = spark.createDataFrame([(1, 2), (1, 3)], "parent INT, amount INT")
    got = joins.with_total(parent, "id", child, "parent", "amount", "total").orderBy("id").collect()
    assert [(r.id, r.total) for r in got] == [(1, 5), (2, None)]


def test_group_sizes(spark):
    rows = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(3,)] * 2 + [(4,)], "g INT")
    s = aggregates.group_size_stats(rows, ["g"]).first()
    assert (s.groups, s.mean, s.min, s.q25, s.q50, s.q75, s.max) == (4, 2.5, 1, 1.75, 2.0, 2.75, 5)
    assert abs(s.std - 1.7320508) < 1e-6


def test_sample_is_repeatable_and_depends_on_the_seed(spark):
    rows = spark.range(500)
    def draw(seed):
        return {r.id for r in sampling.seeded_sample(rows, "id", 20, seed).collect()}
    assert draw(1) == draw(1) != draw(2)
    assert len(sampling.seeded_sample(rows, "id", 1000, 1).collect()) == 500


def test_value_counts_count_nulls(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "v STRING")
    got = [(r.value, r.n) for r in aggregates.value_counts(rows, ["v"]).collect()]
    assert got == [("a", 2), (None, 1)]
