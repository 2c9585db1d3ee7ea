from datetime import datetime, timedelta

from depotline.operators import changes

T0 = datetime(2024, 1, 1)


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, s, T0 + timedelta(hours=h), n) for i, s, h, n in rows],
        "id INT, status STRING, updated_at TIMESTAMP_NTZ, note STRING")


def rows_of(frame):
    return sorted(map(str, map(tuple, frame.collect())))


def test_the_newest_change_wins_and_the_rest_stays(spark):
    target = orders(spark, [(1, "a", 0, "x"), (2, "a", 0, "y"), (3, "a", 0, None)])
    change = orders(spark, [(1, "c", 9, "-"), (1, "b", 5, "-"), (7, "z", 9, "-")])
    got = changes.apply_changes(target, change, ["id"], ["status"])
    assert got.columns == target.columns
    assert rows_of(got) == rows_of(
        orders(spark, [(1, "c", 9, "x"), (2, "a", 0, "y"), (3, "a", 0, None)]))
    assert rows_of(changes.changed_versions(target, change, ["id"], ["status"])) == rows_of(
        orders(spark, [(1, "c", 9, "x")]))


def test_a_change_can_set_null(spark):
    target = orders(spark, [(1, "a", 0, "x")])
    change = orders(spark, [(1, None, 1, "-")])
    assert changes.apply_changes(target, change, ["id"], ["status"]).first().status is None


def test_no_changes_change_nothing(spark):
    target = orders(spark, [(1, "a", 0, "x"), (2, None, 0, "y")])
    assert rows_of(changes.apply_changes(target, target.limit(0), ["id"], ["status"])) == rows_of(
        target)


def test_summary_compares_nulls(spark):
    old = orders(spark, [(1, "a", 0, None), (2, None, 0, None), (3, "a", 0, None)])
    new = orders(spark, [(2, None, 0, None), (3, "b", 0, None), (4, "a", 0, None)])
    got = changes.change_summary(old, new, ["id"], ["status"])
    assert {r.change: r.row_count for r in got.collect()} == {
        "deleted": 1, "unchanged": 1, "updated": 1, "inserted": 1}


def test_soft_delete(spark):
    target = spark.createDataFrame([(1, True), (2, True), (3, False)], "id INT, is_active BOOLEAN")
    gone = spark.createDataFrame([(1,), (1,), (9,)], "id INT")
    got = changes.soft_delete(target, gone, ["id"], T0)
    assert {r.id: r.is_active for r in got.collect()} == {1: False, 2: True, 3: False}
    assert [r.id for r in changes.active_only(got).collect()] == [2]


def test_late_rows(spark):
    source = orders(spark, [(1, "a", 1, None), (2, "b", 2, None), (3, "c", 5, None),
                            (4, "d", 9, None)])
    staged = orders(spark, [(1, "a", 1, None), (2, "b", 1, None)])
    mark = T0 + timedelta(hours=5)
    late = changes.late_rows(source, staged, ["id"], mark)
    assert sorted(r.id for r in late.collect()) == [2, 3]
    bounded = changes.late_rows(source, staged, ["id"], mark, since=T0 + timedelta(hours=3))
    assert [r.id for r in bounded.collect()] == [3]
