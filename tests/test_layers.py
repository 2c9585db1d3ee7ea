"""A small shop from its sources to its figures."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest

from depotline import layers, pipelines
from depotline.operators import marts
from depotline.operators.history import latest_version
from depotline.schemas import EXTRACTED, TABLES
from depotline.sources import csv_files
from depotline.sources.tables import Source

T0 = datetime(2024, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def shop(rating=D("4.0"), changed=T0):
    return {
        "companies": [("c1", "One", "Buyer", "1", rating, "US", "NY", "a", T0, changed),
                      ("c2", "Two", "Supplier", "2", D("3.0"), "UK", "Leeds", "b", T0, T0)],
        "categories": [("k1", "Food", T0, T0), ("k2", "Medical", T0, T0)],
        "customers": [("u1", "c1", "A", "B", "a@x", None, None, None, None, T0, T0),
                      ("u2", "c1", "C", "D", "c@x", None, None, None, None, T0, T0)],
        "suppliers": [("s1", "c2", "Two", None, "s@x", None, T0, T0)],
        "products": [("p1", "A", "Tea", "k1", "B", "Basic", D(1), D(2), True, T0, T0),
                     ("p2", "B", "Mask", "k2", "B", "Basic", D(1), D(2), False, T0, T0)],
        "supplier_product_mapping": [("m1", "s1", "p1", D(1), 3, True, T0, T0),
                                     ("m2", "s1", "p2", D(1), 3, True, T0, T0)],
        "orders": [("o1", "u1", "c1", "l1", day(1), "Delivered", "paid", D(30), day(1), day(1)),
                   ("o2", "u1", "c1", None, day(40), "Shipped", "paid", D(5), day(40), day(40)),
                   ("o3", "u1", "c1", None, day(41), "Cancelled", "pending", D(9), day(41),
                    day(41))],
        "order_items": [("i1", "o1", "m1", 2, D(10), D(0), D(20), T0, T0),
                        ("i2", "o1", "m2", 1, D(10), D(0), D(10), T0, T0),
                        ("i3", "o2", "m1", 1, D(5), D(0), D(5), T0, T0),
                        ("i4", "o3", "m1", 1, D(9), D(0), D(9), T0, T0)],
    }


@pytest.fixture
def built(spark, root):
    source = Source(root=f"{root}/source")

    def put(tables):
        for name, rows in tables.items():
            frame = spark.createDataFrame(rows, TABLES[name].source).coalesce(1)
            frame.write.mode("overwrite").parquet(f"{source.root}/{name}")

    def snapshot(name, rows):
        frame = spark.createDataFrame(rows, TABLES[name].source).coalesce(1)
        csv_files.write_csv(frame, f"{root}/{name}.csv")
        pipelines.run_snapshot(spark, f"{root}/{name}.csv", root, name)

    put(shop())
    pipelines.run_extract(spark, source, root)
    put(shop(rating=D("2.0"), changed=day(9)))
    pipelines.run_extract(spark, source, root)
    lead = ("Website", "x", "g", "cpc", "x", "One", "1-10", "Retail", "US", "NY", 90, D(1500))
    snapshot("marketing_leads", [("l1", *lead, "Won", T0, T0), ("l2", *lead, "Won", T0, T0)])
    snapshot("web_logs", [
        (str(i), "US", "NY", T0, "1.1.1.1", None if i == 0 else f"u{i % 2}", "s", "GET", "/",
         500 if i == 3 else 200, 10, "r", "Mobile", "Edge", i == 0) for i in range(4)])
    layers.build(spark, root)
    return lambda layer, name: layers.read(spark, root, layer, name).collect()


def test_layers(built, spark, root):
    assert {r.order_id for r in built("intermediate", "orders")} == {"o1", "o2", "o3"}
    for name in EXTRACTED:
        keys = [r[0] for r in built("intermediate", name)]
        assert len(keys) == len(set(keys)) > 0, name

    history = sorted((r.company_id, r.rating, r.valid_from, r.valid_to, r.is_current)
                     for r in built("warehouse", "dim_companies"))
    assert history == [("c1", D("2.0"), day(9), None, True), ("c1", D("4.0"), T0, day(9), False),
                       ("c2", D("3.0"), T0, None, True)]
    sales = {r.order_item_id: (r.product_id, r.customer_id, r.is_revenue)
             for r in built("warehouse", "fact_sales")}
    assert sales == {"i1": ("p1", "u1", True), "i2": ("p2", "u1", True),
                     "i3": ("p1", "u1", True), "i4": ("p1", "u1", False)}
    assert {r.order_id: (r.amount, r.units, r.is_revenue)
            for r in built("warehouse", "fact_orders")} == {
        "o1": (D(30), 3, True), "o2": (D(5), 1, True), "o3": (D(9), 1, False)}
    assert {r.lead_id: r.conversion_status for r in built("warehouse", "fact_leads")} == {
        "l1": "Converted", "l2": "Not Converted"}
    assert {r.product_id: r.category_name for r in built("warehouse", "dim_products")} == {
        "p1": "Food", "p2": "Medical"}

    assert {r.month: (r.revenue, r.units, r.orders) for r in built("marts", "revenue_by_month")} \
        == {"2024-01": (D(30), 3, 1), "2024-02": (D(5), 1, 1)}
    assert {r.category_name: r.revenue for r in built("marts", "revenue_by_category")} == {
        "Food": D(25), "Medical": D(10)}
    assert {r.country: r.revenue for r in built("marts", "revenue_by_country")} == {"US": D(35)}
    (average,) = built("marts", "average_order_value")
    assert (average.orders, average.average_order_value) == (2, 17.5)
    assert {r.customer_id: (r.orders, r.revenue) for r in
            built("marts", "customer_lifetime_value")} == {"u1": (2, D(35)), "u2": (0, D(0))}
    (repeat,) = built("marts", "repeat_customers")
    assert (repeat.customers, repeat.repeat_customers, repeat.repeat_share) == (1, 1, 1.0)
    (supplier,) = built("marts", "supplier_performance")
    assert (supplier.revenue, supplier.units, supplier.items, supplier.products) == (D(35), 4, 3, 2)
    (rate,) = built("marts", "lead_conversion_rate")
    assert (rate.source, rate.leads, rate.converted, rate.conversion_rate) == ("Website", 2, 1, .5)
    (funnel,) = built("marts", "lead_funnel")
    assert (funnel.leads, funnel.expected_value, funnel.mean_score) == (2, D(3000), 90.0)
    (traffic,) = built("marts", "traffic_by_day")
    assert (traffic.day, traffic.requests, traffic.users) == ("2024-01-01", 4, 2)
    (errors,) = built("marts", "error_rate")
    assert errors.error_rate == 0.25
    (bots,) = built("marts", "bot_share")
    assert bots.bot_requests == 1
    runs = {r.pipeline_name: (r.runs, r.rows_loaded) for r in built("marts", "pipeline_run_metrics")}
    assert runs["table_extract"] == (2, sum(map(len, shop().values())) + 1)
    with pytest.raises(LookupError):
        layers.read(spark, root, "marts", "no_such_table")


def test_of_versions_with_one_stamp_the_one_loaded_last_counts(spark):
    """In the history as in the newest rows, though the older rating is greater."""
    rows = [(*shop(rating=D(r))["companies"][0], day(n)) for r, n in (("5.0", 1), ("2.0", 2))]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES["companies"].source)
    staged = spark.createDataFrame(rows, f"{fields}, _loaded_at timestamp_ntz")
    newest = latest_version(staged, ["company_id"], ["updated_at", "_loaded_at"]).first()
    (row,) = layers.company_history(staged).collect()
    assert row.rating == newest.rating == D("2.0") and row.is_current


def test_nothing_sold_is_lost(spark):
    """An order without items, an item without an order, an unknown company and pair."""
    orders = spark.createDataFrame(
        [("o1", "u1", "c1", T0, "Shipped"), ("o2", "u1", "c9", T0, "Shipped")],
        "order_id string, customer_id string, company_id string, order_date timestamp_ntz, "
        "order_status string")
    items = spark.createDataFrame(
        [("i1", "o2", "m1", 1, D(5)), ("i2", "o2", "m9", 1, D(7)), ("i3", "o9", "m1", 1, D(9))],
        "order_item_id string, order_id string, supplier_product_id string, quantity int, "
        "line_total decimal(12,2)")
    pairs = spark.createDataFrame([("m1", "s1", "p1")],
                                  "supplier_product_id string, supplier_id string, product_id string")
    named = "category_id string, category_name string"
    products = spark.createDataFrame([("p1", "k1")], "product_id string, category_id string")
    categories = spark.createDataFrame([("k1", "Food")], named)
    companies = spark.createDataFrame([("c1", "US")], "company_id string, country string")
    suppliers = spark.createDataFrame([("s1", "Two")], "supplier_id string, supplier_name string")
    placed = marts.order_fact(orders, items)
    sales = marts.sales_fact(orders, marts.placed_items(items, pairs))
    assert sorted((r.order_id, r.amount, r.units) for r in placed.collect()) == [
        ("o1", D(0), 0), ("o2", D(12), 2)]
    assert sorted((r.order_item_id, r.product_id, r.is_revenue) for r in sales.collect()) == [
        ("i1", "p1", True), ("i2", None, True), ("i3", "p1", False)]
    totals = marts.revenue_reconciliation(
        marts.revenue_by_month(placed), marts.revenue_by_country(placed, companies),
        marts.revenue_by_category(sales, products, categories), marts.revenue_by_product(sales),
        marts.supplier_performance(sales, suppliers))
    assert {r.figure: r.revenue for r in totals.collect()} == dict.fromkeys(
        ["month", "country", "category", "product", "supplier"], D(12))
