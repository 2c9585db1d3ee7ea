"""What the plans must and must not contain."""

import contextlib
import io
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from depotline.plans import QUERIES, shop
from depotline.sources.tables import changed_since

FOLDER = "/root/testdata/sf0.001"

# These write tables while they are built; their plan is only the read that follows.
WRITING = {"csv_snapshot", "csv_append", "stream_arrivals", "staging_load", "run_log_counts",
           "version_switch", "warehouse_build", "warehouse_rebuild", "quality_report", "run_profile",
           "late_row_repair", "csv_bad_lines", "null_counts"}


def plan(frame) -> str:
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        frame.explain("formatted")
    return shown.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(build(spark, FOLDER))
            for name, build in QUERIES.items() if name not in WRITING}


def test_no_query_leaves_the_jvm_or_pairs_everything(plans):
    for name, text in plans.items():
        for node in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


def test_only_keyed_windows(plans):
    """A window whose first argument is an ordering has no key and would be one task."""
    for name, text in plans.items():
        assert not re.search(r"windowspecdefinition\([^,]* (ASC|DESC)", text), name


def test_absence_is_an_anti_join(plans):
    for name in ("orders_without_items", "orders_without_lead", "late_rows"):
        assert "LeftAnti" in plans[name], name


def test_samples_and_previews_sort_nothing_as_a_whole(plans):
    for name in ("preview_first_rows", "seeded_sample"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_watermarks_reach_the_scan(spark):
    orders = shop.orders(spark, FOLDER).select("order_id", "updated_at")
    text = plan(changed_since(orders, datetime(2000, 1, 1), datetime(2001, 1, 1)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThan(o_orderdate" in pushed and "LessThanOrEqual(o_orderdate" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


@pytest.mark.parametrize("name, table, columns", [
    ("revenue_by_month", "lineitem",
     "l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double"),
    ("orders_without_items", "lineitem", "l_orderkey:bigint"),
    ("duplicate_keys", "lineitem", "l_orderkey:bigint,l_linenumber:int"),
])
def test_only_needed_columns_are_read(plans, name, table, columns):
    assert f"ReadSchema: struct<{columns}>" in plans[name], plans[name]


def test_a_history_reads_its_own_columns_only(spark):
    """Histories are cut into written parts; this is the scan that feeds them."""
    versions = shop.company_versions(spark, FOLDER).select("company_id", "updated_at", "segment")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan(versions)


def test_one_grouping_per_key(spark):
    from depotline.operators.keyrules import check_keys
    from depotline.rules import key_rules
    frames = dict(zip(["orders", "order_items"], shop.load(spark, FOLDER, "orders", "order_items"), strict=True))
    rules = [r for r in key_rules() if r.key == "orders.order_id"]
    assert {r.rule for r in rules} >= {"order_id_unique", "order_id_reference", "items_per_order",
                                       "total_is_sum_of_items"}
    text = plan(check_keys(rules, frames)).split("\n\n")[0]
    # One shuffle by the key, one for the sums over all keys; a scan per table.
    assert text.count("Exchange") == 2 and text.count("Scan parquet") == 2


def test_totals_are_summed_before_they_are_joined(plans):
    tree = plans["order_total_mismatch"]
    join = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", tree).start()
    assert "HashAggregate" in tree[join:]


def test_one_scan_for_all_row_rules(spark):
    from depotline.operators import quality
    from depotline.schemas import TABLES
    orders = shop.orders(spark, FOLDER)
    rules = {k: r for k, r in quality.row_rules(TABLES["orders"]).items() if "created_at" not in r}
    assert len(rules) > 10
    text = plan(quality.check_rows(orders, "orders", rules))
    assert text.split("\n\n")[0].count("Scan parquet") == 1


def test_a_hot_key_of_a_row_join_is_split(spark):
    """With the thresholds lowered to test size the hot partition is read in parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") < 150_000, F.lit(3)).otherwise(F.col("id")).alias("key"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        parents = spark.range(0, 400_000, 1, 8).select(F.col("id").alias("key"),
                                                       F.lit("x").alias("name"))
        joined = facts.join(parents, "key")
        assert joined.select(F.sum(F.length("payload"))).first()[0] == 400_000 * 64
        rows = joined.select("key", F.length("payload").alias("n"))
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
