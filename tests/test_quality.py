from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotline.operators import keyrules, quality
from depotline.operators.profile import profile, shape
from depotline.rules import key_rules
from depotline.schemas import TABLES
from depotline.sources.conform import accepted, conform, rejected

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 6, 1)


def result(report):
    return {(r.table_name, r.rule): (r.checked, r.failed) for r in report.collect()}


@pytest.fixture
def frames(spark):
    """A small shop that meets every rule."""
    def frame(name, rows):
        return spark.createDataFrame(rows, TABLES[name].source)

    cent = Decimal("10.00")
    return {
        "companies": frame("companies", [
            ("c1", "One", "Buyer", "1", Decimal("4.5"), "US", "NY", "a", EARLY, LATE),
            ("c2", "Two", "Supplier", "2", Decimal("1.0"), "US", "NY", "b", EARLY, EARLY)]),
        "categories": frame("categories", [("k1", "Food", EARLY, EARLY)]),
        "customers": frame("customers", [
            (f"u{i}", "c1", "A", "B", f"a{i}@x", None, None, None, None, EARLY, EARLY) for i in range(1, 11)]),
        "suppliers": frame("suppliers", [("s1", "c2", "Two", None, "s@x", None, EARLY, EARLY),
                                         ("s2", "c2", "Two", None, "t@x", None, EARLY, EARLY)]),
        "products": frame("products", [
            ("p1", "AA-1", "Tea", "k1", "B", "Basic", cent, cent, True, EARLY, EARLY)]),
        "supplier_product_mapping": frame("supplier_product_mapping", [
            ("m1", "s1", "p1", cent, 3, True, EARLY, EARLY),
            ("m2", "s2", "p1", cent, 3, False, EARLY, EARLY)]),
        "orders": frame("orders", [
            ("o1", "u1", "c1", "l1", EARLY, "Shipped", "paid", cent, EARLY, EARLY)]),
        "order_items": frame("order_items", [
            ("i1", "o1", "m1", 1, cent, Decimal("0.00"), cent, EARLY, EARLY)]),
        "marketing_leads": frame("marketing_leads", [
            ("l1", "web", "c", "u", "m", "k", "One", "1-10", "i", "US", "NY", 90, Decimal("2000.00"), "Won",
             EARLY, EARLY)]),
        "web_logs": frame("web_logs", [
            ("w1", "US", "NY", EARLY, "1.1.1.1", None, "s", "GET", "/", 200, 9, "-", "d", "b", False)]),
    }


def test_a_sound_shop_passes_every_rule(frames):
    report = quality.quality_report(list(TABLES.values()), frames, key_rules(), {"categories": (1, 1)})
    found = result(quality.gate(report))
    assert all(failed == 0 for _, failed in found.values())
    for name in frames:
        table = TABLES[name]
        rules = {rule for t, rule in found if t == name}
        assert {f"{c}_not_null" for c in table.required} <= rules
        assert {f"{c}_reference" for c in table.references} <= rules
        assert {"_".join(k) + "_unique" for k in [table.key, *table.unique]} <= rules
    assert sum(len(TABLES[n].references) for n in frames) == 9
    assert found["categories", "row_count"] == (1, 0)
    assert found["orders", "total_is_sum_of_items"] == (1, 0)


def test_every_fault_is_counted(spark, frames):
    bad = spark.createDataFrame([
        ("o1", "u1", "c1", None, EARLY, "Shipped", "paid", Decimal("1.00"), LATE, EARLY),
        ("o1", "u99", "c1", None, EARLY, "Lost", "paid", Decimal("-1.00"), EARLY, LATE),
        ("o2", None, "c1", "x" * 33, EARLY, None, "paid", None, EARLY, LATE),
    ], TABLES["orders"].source)
    found = result(quality.quality_report([TABLES["orders"]], {**frames, "orders": bad}, key_rules()))
    failed = {rule: f for (t, rule), (_, f) in found.items() if f and t == "orders"}
    assert failed == {
        "customer_id_not_null": 1, "order_status_not_null": 1, "order_total_not_null": 1,
        "order_status_allowed": 1, "lead_id_length": 1, "total_not_negative": 1,
        "payment_fits_status": 2, "updated_after_created": 1, "order_id_unique": 1,
        "customer_id_reference": 1, "lead_id_reference": 1, "total_is_sum_of_items": 1,
        "order_has_items": 1, "items_per_order": 1,
    }
    assert found["orders", "customer_id_reference"] == (2, 1)


def test_faults_across_rows_and_tables(spark, frames):
    """Each change breaks the rules named with it, and no other."""
    day = F.lit(datetime(2023, 1, 1)).cast("timestamp_ntz")
    cases = [
        ("companies", lambda c: c.withColumn("company_type", F.lit("Supplier")),
         {"under_a_buyer": 10, "well_rated_buyer": 1}),
        ("companies", lambda c: c.withColumn("rating", F.lit("1.5").cast("decimal(2,1)")), {"well_rated_buyer": 1}),
        ("customers", lambda c: c.where("customer_id <> 'u2'"), {"customers_per_company": 1}),
        ("customers", lambda c: c.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY")),
         {"order_not_before_customer": 1}),
        ("marketing_leads", lambda c: c.withColumns({"created_at": F.lit(LATE).cast("timestamp_ntz"),
                                                     "updated_at": F.lit(LATE).cast("timestamp_ntz")}),
         {"order_not_before_lead": 1}),
        ("supplier_product_mapping", lambda c: c.withColumn("is_preferred_supplier", F.lit(True)),
         {"one_preferred_supplier": 1}),
        ("supplier_product_mapping", lambda c: c.where("supplier_product_id = 'm1'"), {"suppliers_per_product": 1}),
        ("order_items", lambda c: c.withColumn("line_total", F.lit("9.99").cast("decimal(12,2)")),
         {"total_is_sum_of_items": 1}),
        ("order_items", lambda c: c.limit(0), {"order_has_items": 1, "items_per_order": 1}),
        ("orders", lambda c: c.withColumn("lead_id", F.lit(None).cast("string")), {"won_lead_has_one_order": 1}),
        ("orders", lambda c: c.withColumn("order_date", day),
         {"order_not_before_customer": 1, "order_not_before_lead": 1}),
    ]
    for name, change, want in cases:
        reading = [r for r in key_rules() if name in {f.table for f in r.figures.values()}]
        found = result(keyrules.check_keys(reading, {**frames, name: change(frames[name])}))
        assert {rule: f for (_, rule), (_, f) in found.items() if f} == want, want


def test_formulas_of_a_row(frames):
    cases = {"order_items": (F.lit("9.99").cast("decimal(12,2)"), "line_total", "line_total_formula"),
             "marketing_leads": (F.lit(7), "lead_score", "score_fits_stage"),
             "orders": (F.lit("pending"), "payment_status", "payment_fits_status")}
    for name, (value, column, rule) in cases.items():
        rules = quality.row_rules(TABLES[name])
        found = result(quality.check_rows(frames[name].withColumn(column, value), name, rules))
        assert {r: f for (_, r), (_, f) in found.items() if f} == {rule: 1}


def test_a_rule_that_cannot_be_judged_does_not_pass(frames):
    some = {n: frames[n] for n in ("orders", "customers")} | {
        "companies": frames["companies"].drop("rating")}
    report = quality.quality_report(list(TABLES.values()), some, key_rules())
    found = result(report)
    assert found["orders", "order_has_items"] == found["companies", "rating_range"] == (None, None)
    assert found["orders", "well_rated_buyer"] == (None, None) and found["customers", "under_a_buyer"] == (10, 0)
    with pytest.raises(quality.QualityError, match=r"companies\.rating_range \(not judged\)"):
        quality.gate(report)
    quality.gate(report, unjudged="pass")


def test_a_hot_key_with_faults_is_counted_whole(spark):
    child = spark.range(3_000).select(F.when(F.col("id") < 1_500, 7).otherwise(F.col("id")).alias("parent"))
    parent = spark.createDataFrame([(7,), (7,), (2_000,)], "key LONG")
    rules = [keyrules.reference("c", "parent", "p", "key"), keyrules.unique("p", ["key"], "p.key"),
             keyrules.children_between("few", "p", "key", "c", "parent", 1, 9)]
    got = {r.rule: (r.checked, r.failed) for r in keyrules.check_keys(rules, {"c": child, "p": parent}).collect()}
    assert got == {"parent_reference": (3_000, 1_499), "key_unique": (3, 1), "few": (2, 1)}
    none = {"c": child.limit(0), "p": parent.limit(0)}
    assert {(r.checked, r.failed) for r in keyrules.check_keys(rules, none).collect()} == {(0, 0)}


def test_steps_between_versions(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "a"), (2, 1, "a"), (2, 2, "a")],
                                 "k INT, at INT, s STRING")
    found = result(quality.check_steps(rows, "t", ["k"], "at", "s", {"a": ["b"]}))
    assert found == {("t", "status_steps_legal"): (3, 1)}


def test_the_gate_names_what_failed(spark):
    rows = spark.createDataFrame([(1,), (-1,)], "n INT")
    report = quality.check_rows(rows, "t", {"positive": "n > 0", "small": "n < 9"})
    with pytest.raises(quality.QualityError, match=r"t\.positive \(1\)"):
        quality.gate(report)


def test_null_meets_a_rule(spark):
    rows = spark.createDataFrame([(None,), (1,)], "n INT")
    assert quality.failing_rows(rows, "n > 5").count() == 1
    assert result(quality.check_rows(rows, "t", {"r": F.col("n") > 5})) == {("t", "r"): (2, 1)}


def test_checks_on_empty_tables(spark):
    none = spark.createDataFrame([], "id INT, parent INT")
    assert result(quality.check_rows(none, "t", {"r": "id > 0"})) == {("t", "r"): (0, 0)}
    assert result(quality.check_unique(none, "t", ["id"])) == {("t", "id_unique"): (0, 0)}
    assert result(quality.check_reference(none, "t", "parent", none, "id")) == {
        ("t", "parent_reference"): (0, 0)}
    assert result(quality.check_count(none, "t", 1, 5)) == {("t", "row_count"): (0, 1)}


def test_reference_with_repeated_parents_and_a_hot_key(spark):
    child = spark.range(3000).select(
        F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("parent"))
    parent = spark.createDataFrame([(7,), (7,), (2000,)], "key LONG")
    found = result(quality.check_reference(child, "t", "parent", parent, "key"))
    assert found == {("t", "parent_reference"): (3000, 1499)}


def test_children_bounds_include_parents_without_children(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    child = spark.createDataFrame([(1,), (1,), (2,), (9,)], "parent INT")
    got = quality.outside_bounds(parent, "id", child, "parent", 1, 1).collect()
    assert {r.id: r.children for r in got} == {1: 2, 3: 0}


def test_profile(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "n INT, s STRING")
    got = [tuple(r) for r in profile(rows, "t").orderBy("position").collect()]
    assert got == [("t", 1, "n", "int", 2, 2, 0), ("t", 2, "s", "string", 2, 1, 1)]
    assert tuple(shape(rows, "t").first()) == ("t", 2, 2)


def test_conform_keeps_what_does_not_fit(spark):
    rows = spark.createDataFrame(
        [("1", "p", Decimal("99999999.99"), 5), ("2", "p", Decimal("100000000.00"), 6)],
        "supplier_product_id STRING, product_id STRING, supplier_price DECIMAL(12,2), extra INT")
    layout = TABLES["supplier_product_mapping"].staging
    fitted = conform(rows, layout)
    assert accepted(fitted).columns == layout.fieldNames()
    assert [(r.supplier_product_id, r.supplier_price) for r in accepted(fitted).collect()] == [
        ("1", Decimal("99999999.99"))]
    (bad,) = rejected(fitted).collect()
    assert bad.supplier_product_id == "2" and bad["_rejected"] == ["supplier_price"]
    assert bad.lead_time_days is None


def test_staging_is_narrower_where_it_should_be():
    kinds = {f.name: f.dataType.simpleString() for f in TABLES["order_items"].staging}
    assert kinds["line_total"] == kinds["unit_price"] == "decimal(10,2)"
    assert dict((f.name, f.dataType.simpleString()) for f in TABLES["orders"].staging)[
        "order_total"] == "decimal(12,2)"
