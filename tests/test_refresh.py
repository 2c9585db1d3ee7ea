"""Refreshed facts and sums against a full build of the same staging."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from depotline import layers, pipelines, refresh
from depotline.operators import deltas, marts
from depotline.schemas import TABLES
from depotline.sources.tables import Source
from depotline.state import journal

T0 = datetime(2024, 1, 1)
TABLES_USED = ["orders", "order_items", "supplier_product_mapping"]


def day(n):
    return T0 + timedelta(days=n)


def order(i, status="Shipped", changed=0, at=None):
    when = day(i * 3 if at is None else at)
    return (f"o{i}", f"u{i % 4}", f"c{i % 3}", None, when, status, "paid", D(9), T0, day(changed))


def item(i, of, amount=10, changed=0, pair="m1"):
    return (f"i{i}", None if of is None else f"o{of}", pair, 2, D(amount), D(0), D(2 * amount), T0, day(changed))


@pytest.fixture
def put(spark, root):
    source = Source(root=f"{root}/source")

    def write(**tables):
        for name, rows in tables.items():
            frame = spark.createDataFrame(rows, TABLES[name].source).coalesce(1)
            frame.write.mode("overwrite").parquet(f"{source.root}/{name}")
        return source

    return write


def rows_of(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def equals_full_build(spark, root):
    latest = {t: pipelines.read_latest(spark, root, t) for t in TABLES_USED}
    facts = {"fact_orders": marts.order_fact(latest["orders"], latest["order_items"]),
             "fact_sales": marts.sales_fact(latest["orders"], marts.placed_items(
                 latest["order_items"], latest["supplier_product_mapping"]))}
    for name in TABLES_USED:
        assert rows_of(refresh.read(spark, root, name), TABLES[name].columns) == rows_of(
            latest[name], TABLES[name].columns), name
    for name, fact in facts.items():
        assert rows_of(refresh.read(spark, root, name), fact.columns) == rows_of(fact, fact.columns), name
    for name, sums in refresh.SUMS.items():
        columns = [*sums.by, *sums.values, sums.rows]
        assert rows_of(refresh.read(spark, root, name), columns) == rows_of(
            deltas.totals(facts[sums.fact], sums), columns), name
    assert rows_of(refresh.read(spark, root, "revenue_by_month"), ["month", "revenue", "units", "orders"]) == rows_of(
        marts.revenue_by_month(facts["fact_orders"]), ["month", "revenue", "units", "orders"])


def test_refreshes_equal_a_full_build(spark, root, put):
    orders = [order(i) for i in range(40)]
    items = [item(i, i % 35, amount=i + 1, pair=f"m{i % 3}") for i in range(90)] + [item(99, None)]
    pairs = [(f"m{i}", f"s{i}", f"p{i}", D(1), 3, True, T0, T0) for i in range(2)]
    source = put(orders=orders, order_items=items, supplier_product_mapping=pairs)
    pipelines.run_extract(spark, source, root, tables=TABLES_USED)
    first = refresh.refresh(spark, root)
    assert first.read == {"orders": 40, "order_items": 91, "supplier_product_mapping": 2}
    equals_full_build(spark, root)

    # Cancelled, moved to another month, new; an item changed, moved to another order, new; a pair found.
    orders[3], orders[4] = order(3, "Cancelled", 5), order(4, changed=5, at=200)
    orders += [order(50, changed=5)]
    items[7], items[8] = item(7, 7, 500, 5), item(8, 11, 9, 5, "m2")
    items += [item(200, 50, 4, 5), item(201, 77, 4, 5)]
    pairs += [("m2", "s9", "p9", D(1), 3, True, T0, day(5))]
    put(orders=orders, order_items=items, supplier_product_mapping=pairs)
    pipelines.run_extract(spark, source, root, tables=TABLES_USED)
    second = refresh.refresh(spark, root)
    assert second.read == {"orders": 3, "order_items": 4, "supplier_product_mapping": 1}
    assert second.touched < 40
    equals_full_build(spark, root)

    # A late row with an old stamp, and one that is older than what is stored.
    late = spark.createDataFrame([order(60, changed=-9), order(4, "Pending", -9)], TABLES["orders"].source)
    pipelines.load_table(late, root, "orders", datetime.now())
    third = refresh.refresh(spark, root)
    assert third.read["orders"] == 2 and third.read["order_items"] == 0
    equals_full_build(spark, root)

    assert sum(refresh.refresh(spark, root).read.values()) == 0
    equals_full_build(spark, root)


def test_a_refresh_that_dies_is_repeated(spark, root, put, monkeypatch):
    source = put(orders=[order(1), order(2)], order_items=[item(1, 1), item(2, 2)],
                 supplier_product_mapping=[("m1", "s1", "p1", D(1), 3, True, T0, T0)])
    pipelines.run_extract(spark, source, root, tables=TABLES_USED)
    refresh.refresh(spark, root)
    put(orders=[order(1, "Cancelled", 5), order(2)])
    pipelines.run_extract(spark, source, root, tables=TABLES_USED)

    def broken(*_):
        raise RuntimeError("no switch")

    with monkeypatch.context() as patch:
        patch.setattr(refresh.versions, "switch_all", broken)
        with pytest.raises(RuntimeError, match="no switch"):
            refresh.refresh(spark, root)
    assert refresh.read(spark, root, "fact_orders").where("is_revenue").count() == 2
    with monkeypatch.context() as patch:  # dies behind the switch: the mark stays, the rows are read again
        patch.setattr(refresh.journal, "save_marks", broken)
        with pytest.raises(RuntimeError, match="no switch"):
            refresh.refresh(spark, root)
    equals_full_build(spark, root)
    refresh.refresh(spark, root)
    equals_full_build(spark, root)


def test_rows_of_a_run_under_way_are_read_again(spark, root, put):
    source = put(orders=[order(1)], order_items=[item(1, 1)], supplier_product_mapping=[])
    started = datetime.now() - timedelta(minutes=1)
    journal.start_run(spark, root, "slow", started)
    pipelines.run_extract(spark, source, root, tables=TABLES_USED)
    refresh.refresh(spark, root)
    late = spark.createDataFrame([order(2)], TABLES["orders"].source)
    pipelines.load_table(late, root, "orders", started)  # stamped before the refresh, written after it
    refresh.refresh(spark, root)
    equals_full_build(spark, root)


def test_only_recent_load_folders_are_read(spark, root):
    old = spark.createDataFrame([order(1)], TABLES["orders"].source)
    pipelines.load_table(old, root, "orders", datetime(2024, 1, 1, 12))
    pipelines.load_table(old, root, "orders", datetime(2024, 3, 1, 12))
    since = refresh._staged_since(spark, root, "orders", datetime(2024, 2, 1))
    assert since.count() == 1 and len(since.inputFiles()) == 2
    scan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_date" in scan


def test_groups_without_rows_are_gone(spark):
    sums = deltas.Sums("f", {"g": "g"}, {"v": "v"})
    frame = lambda rows: spark.createDataFrame(rows, "g STRING, v INT")
    stored = deltas.totals(frame([("a", 1), ("a", 2), ("b", 5), (None, 1), ("z", 0)]), sums)
    moved = deltas.change(frame([("b", 5), (None, 1), ("a", 2)]), frame([("a", 9), (None, None)]), sums)
    got = {r.g: (r.v, r._rows) for r in deltas.merged(stored, moved, sums).collect()}
    assert got == {"a": (10, 2), None: (0, 1), "z": (0, 1)}


def test_the_layers_know_the_company_of_the_time(spark, root, put):
    company = TABLES["companies"].source
    source = put(orders=[order(1, at=5), order(4, at=50)], order_items=[item(1, 1), item(2, 4)],
                 supplier_product_mapping=[], companies=[
                     ("c1", "One", "Buyer", "1", D("4.0"), "US", "NY", "a", T0, T0)])
    pipelines.run_extract(spark, source, root, tables=[*TABLES_USED, "companies"])
    moved = spark.createDataFrame([("c1", "One", "Buyer", "1", D("4.0"), "UK", "NY", "a", T0, day(20))], company)
    moved.coalesce(1).write.mode("append").parquet(f"{source.root}/companies")
    pipelines.run_extract(spark, source, root, tables=["companies"])
    layers.build(spark, root, [*TABLES_USED, "companies"],
                 ["dim_companies", "fact_orders", "fact_orders_as_of"],
                 ["revenue_by_country", "revenue_by_country_at_order"])
    now = layers.read(spark, root, "marts", "revenue_by_country")
    then = layers.read(spark, root, "marts", "revenue_by_country_at_order")
    assert {r.country: r.revenue for r in now.collect()} == {"UK": 40}
    assert {r.country: r.revenue for r in then.select("country", F.col("revenue")).collect()} == {"US": 20, "UK": 20}
