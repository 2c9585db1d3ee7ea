"""Histories against brute force, one key owning most versions included."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from depotline.operators import history

START = datetime(2024, 1, 1)


def versions(seed, keys=40, hot=600):
    """Random versions; key 0 is hot. Times repeat and values repeat."""
    draw = random.Random(seed)
    rows = []
    for key in range(keys):
        for _ in range(hot if key == 0 else draw.randint(1, 12)):
            at = START + timedelta(hours=draw.randint(0, 24 * 40))
            rows.append((key, at, draw.choice(["a", "b", None]), draw.choice([1, 2])))
    return rows


def by_key(rows):
    grouped = defaultdict(list)
    for key, at, *values in rows:
        grouped[key].append((at, *values))
    return grouped


def rank(value):
    return (value is not None, value)


def brute_history(rows):
    result = []
    for key, seen in by_key(rows).items():
        single = {}
        for at, *values in sorted(seen, key=lambda r: (r[0], *[rank(v) for v in r[1:]])):
            single[at] = tuple(values)
        starts = []
        for at, values in sorted(single.items(), key=lambda r: r[0]):
            if not starts or starts[-1][1] != values:
                starts.append((at, values))
        for i, (at, values) in enumerate(starts):
            end = starts[i + 1][0] if i + 1 < len(starts) else None
            result.append((key, *values, at, end, end is None))
    return result


@pytest.fixture
def many_parts(spark):
    """Parts are not merged, however small."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(
        rows, "id INT, at TIMESTAMP_NTZ, grade STRING, size INT")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scd2_equals_brute_force(frame, many_parts, seed):
    rows = versions(seed)
    got = history.scd2(frame(rows), ["id"], "at", ["grade", "size"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_history(rows)))


def test_scd2_intervals_meet_and_one_row_is_current(frame):
    got = history.scd2(frame(versions(4)), ["id"], "at", ["grade", "size"]).collect()
    spans = defaultdict(list)
    for row in got:
        spans[row.id].append((row.valid_from, row.valid_to, row.is_current))
    for found in spans.values():
        found.sort(key=lambda s: s[0])
        assert [s[2] for s in found] == [False] * (len(found) - 1) + [True]
        assert all(a[1] == b[0] for a, b in zip(found, found[1:]))


def test_as_of_gives_one_row_per_started_key(frame):
    rows = versions(5)
    when = START + timedelta(days=20)
    got = history.as_of(history.scd2(frame(rows), ["id"], "at", ["grade", "size"]), when)
    keys = [r.id for r in got.collect()]
    started = {key for key, at, *_ in rows if at <= when}
    assert sorted(keys) == sorted(started)


def test_refresh_after_late_versions_equals_a_full_build(frame):
    rows = versions(6)
    early, late = rows[: len(rows) // 2], rows[len(rows) // 2:]
    old = history.scd2(frame(early), ["id"], "at", ["grade", "size"])
    touched = frame(late).select("id").distinct()
    got = history.refresh_scd2(old, frame(rows), touched, ["id"], "at", ["grade", "size"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_history(rows)))


def test_a_null_key_and_a_burst_within_a_minute(frame, many_parts):
    """Both own most rows, and no part holds all rows of either."""
    draw = random.Random(11)
    rows = [(key, START + timedelta(microseconds=draw.randrange(10**6)), draw.choice("ab"), 1)
            for key in (None, 7) for _ in range(500)] + versions(12, hot=10)
    got = history.scd2(frame(rows), ["id"], "at", ["grade", "size"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_history(rows)))
    parts = history._parted(frame(rows), ["id", "at"]).groupBy("_part", "id").count().collect()
    for key in (None, 7):
        held = [r["count"] for r in parts if r.id == key]
        assert len(held) > 1 and max(held) < 400


def test_previous_crosses_parts(frame, many_parts):
    rows = [(1, START, "a", 1), (1, START + timedelta(days=9), "b", 1),
            (1, START + timedelta(days=9, seconds=1), "c", 1), (2, START, "z", 1)]
    found = history.with_previous(frame(rows), ["id"], "at", ["grade"])
    got = found.orderBy("id", "at").collect()
    assert [r.previous and r.previous.grade for r in got] == [None, "a", "b", None]


def test_steps_of_a_hot_key_equal_brute_force(frame, many_parts):
    rows = sorted({(key, at, size) for key, at, _, size in versions(10)})
    single = frame(versions(10)).select("id", "at", "size").distinct()
    got = history.steps(single, ["id"], "at", "size").collect()
    wanted = [(a[0], b[1], a[2], b[2]) for a, b in zip(rows, rows[1:]) if a[0] == b[0]]
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert len(got) > 500


def test_no_zone_disturbs_the_order(spark, frame):
    """Two versions around the hour a summer-time zone skips."""
    rows = [(1, datetime(2024, 3, 31, 2, 30), "a", 1), (1, datetime(2024, 3, 31, 3, 15), "b", 1)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = history.scd2(frame(rows), ["id"], "at", ["grade"]).orderBy("valid_from").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(r.grade, r.is_current) for r in got] == [("a", False), ("b", True)]


def test_latest_version(frame):
    rows = versions(7)
    got = history.latest_version(frame(rows), ["id"], ["at"]).collect()
    wanted = [
        (key, *max(seen, key=lambda r: (r[0], *[rank(v) for v in r[1:]])))
        for key, seen in by_key(rows).items()
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_latest_version_is_idempotent_and_absorbs_replays(frame):
    rows = frame(versions(8))
    once = history.latest_version(rows, ["id"], ["at"])
    again = history.latest_version(once, ["id"], ["at"])
    replayed = history.latest_version(rows.unionAll(rows), ["id"], ["at"])
    assert once.exceptAll(again).count() == 0
    assert once.exceptAll(replayed).count() == replayed.exceptAll(once).count() == 0


def test_illegal_steps(frame):
    rows = [(1, START + timedelta(hours=i), g, 1) for i, g in enumerate("aabca")]
    got = history.illegal_steps(frame(rows), ["id"], "at", "grade", {"a": ["b"], "b": ["c"]})
    assert [(r.from_status, r.to_status) for r in got.collect()] == [("c", "a")]


def test_a_step_into_an_end_state_only(frame):
    rows = [(1, START, "a", 1), (1, START + timedelta(days=1), "b", 1)]
    got = history.illegal_steps(frame(rows), ["id"], "at", "grade", {"a": [], "b": ["a"]})
    assert got.count() == 1


def test_history_of_nothing(frame):
    assert history.scd2(frame([]), ["id"], "at", ["grade"]).count() == 0


def test_extra_columns_stay(frame):
    got = history.with_previous(frame(versions(9)), ["id"], "at", ["grade"])
    assert got.columns == ["id", "at", "grade", "size", "previous"]
    assert got.where(F.col("size").isNull()).count() == 0


def brute_as_of(facts, versions_):
    out = []
    for key, at, name in facts:
        held = [(v_at, value) for v_key, v_at, value in versions_
                if v_key == key and key is not None and at is not None and v_at <= at]
        out.append((key, at, name, *(max(held) if held else (None, None))))
    return sorted(map(str, out))


@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_join_equals_brute_force(spark, many_parts, seed):
    """One key owns a third of all facts, some lie before its first version, some at its very time."""
    draw = random.Random(seed)

    def moment_():
        return START + timedelta(hours=draw.randint(0, 400))

    told = {(draw.choice([0, 0, 0, *range(1, 30)]), moment_()): draw.choice("xyz") for _ in range(250)}
    told = [(k, at + timedelta(hours=60), v) for (k, at), v in told.items()]
    facts = [(draw.choice([0] * 15 + [*range(1, 40), None]), draw.choice([None] + [moment_()] * 40), f"f{i}")
             for i in range(900)]
    facts += [(5, START + timedelta(hours=100), "same")] * 40
    got = history.as_of_join(
        spark.createDataFrame(facts, "id INT, at TIMESTAMP_NTZ, name STRING"),
        spark.createDataFrame(told, "id INT, since TIMESTAMP_NTZ, value STRING"),
        ["id"], "at", "since", ["since", "value"])
    assert got.columns == ["id", "at", "name", "since", "value"]
    assert sorted(map(str, map(tuple, got.collect()))) == brute_as_of(facts, told)


def test_as_of_join_without_versions_or_facts(spark):
    facts = spark.createDataFrame([(1, START)], "id INT, at TIMESTAMP_NTZ")
    none = spark.createDataFrame([], "id INT, since TIMESTAMP_NTZ, value STRING")
    assert [tuple(r) for r in history.as_of_join(facts, none, ["id"], "at", "since", ["value"]).collect()] == [
        (1, START, None)]
    assert history.as_of_join(facts.limit(0), none, ["id"], "at", "since", ["value"]).count() == 0
