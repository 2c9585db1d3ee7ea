"""History, star schema and key figures of the shop."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.operators import history, marts
from depotline.plans import shop
from depotline.plans.registry import as_double, query
from depotline.plans.shop import with_views
from depotline.schemas import RUN_EVENTS
from depotline.sources.conform import accepted, conform
from depotline.state import journal

_HISTORY = """
SELECT company_id, segment, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY company_id ORDER BY updated_at) AS valid_to
FROM (SELECT *, lag(segment) OVER (PARTITION BY company_id ORDER BY updated_at) AS before
      FROM (SELECT company_id, updated_at, max(segment) AS segment
            FROM company_versions GROUP BY 1, 2))
WHERE before IS NULL OR before <> segment"""
_WHEN = datetime(2024, 1, 15, 12)


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    return marts.order_fact(*shop.load(spark, folder, "orders", "order_items"))


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_fact(*shop.load(spark, folder, "orders", "order_items"), "line_number")


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return history.scd2(shop.company_versions(spark, folder), ["company_id"], "updated_at",
                        ["segment"])


@query(with_views("company_versions", """
SELECT *, valid_to IS NULL AS is_current FROM history""", history=_HISTORY))
def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder)


@query(with_views("company_versions", f"""
SELECT company_id, segment, valid_from FROM history
WHERE valid_from <= TIMESTAMP '{_WHEN}' AND (valid_to > TIMESTAMP '{_WHEN}' OR valid_to IS NULL)
""", history=_HISTORY))
def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    then = history.as_of(_history(spark, folder), _WHEN)
    return then.select("company_id", "segment", "valid_from")


@query(with_views("company_versions", """
SELECT *, valid_to IS NULL AS is_current FROM history""", history=_HISTORY))
def scd2_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A history from the first half of the versions, brought up to date by touched key."""
    versions = shop.company_versions(spark, folder)
    late = F.col("updated_at") > F.lit(str(_WHEN)).cast("timestamp_ntz")
    early = history.scd2(versions.where(~late), ["company_id"], "updated_at", ["segment"])
    touched = versions.where(late).select("company_id").distinct()
    return history.refresh_scd2(early, versions, touched, ["company_id"], "updated_at",
                                ["segment"])


@query(with_views("company_versions", """
SELECT from_status, to_status, count(*) AS steps FROM (
    SELECT lag(segment) OVER (PARTITION BY company_id ORDER BY updated_at, segment) AS from_status,
           segment AS to_status FROM company_versions)
WHERE from_status IS NOT NULL GROUP BY ALL"""))
def status_changes(spark: SparkSession, folder: str) -> DataFrame:
    found = history.steps(shop.company_versions(spark, folder), ["company_id"], "updated_at",
                          "segment")
    return found.groupBy("from_status", "to_status").agg(F.count(F.lit(1)).alias("steps"))


@query(with_views("shop_orders marketing_leads", """
SELECT lead_id, funnel_stage,
       CASE WHEN lead_id IN (SELECT lead_id FROM shop_orders WHERE lead_id IS NOT NULL)
            THEN 'Converted' ELSE 'Not Converted' END AS conversion_status
FROM marketing_leads"""))
def conversion_status(spark: SparkSession, folder: str) -> DataFrame:
    leads, orders = shop.load(spark, folder, "marketing_leads", "orders")
    return marts.conversion(leads.select("lead_id", "funnel_stage"), orders)


@query(with_views("products categories", """
SELECT product_id, product_name, category_name, brand, is_active
FROM products LEFT JOIN categories USING (category_id)"""))
def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.dim_products(*shop.load(spark, folder, "products", "categories"))
    return found.select("product_id", "product_name", "category_name", "brand", "is_active")


@query(with_views("customers companies", """
SELECT customer_id, company_id, company_name, company_type, country, job_title
FROM customers LEFT JOIN companies USING (company_id)"""))
def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.dim_customers(*shop.load(spark, folder, "customers", "companies"))
    return found.drop("customer_name", "created_at")


@query(with_views("suppliers companies", """
SELECT supplier_id, company_id, supplier_name, company_type, CAST(rating AS DOUBLE) AS rating,
       country FROM suppliers LEFT JOIN companies USING (company_id)"""))
def dim_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.dim_suppliers(*shop.load(spark, folder, "suppliers", "companies"))
    return found.withColumn("rating", F.col("rating").cast("double"))


@query(with_views("shop_orders order_items", """
SELECT order_id, line_number, supplier_id, product_id, quantity,
       CAST(line_total AS DOUBLE) AS line_total, customer_id, company_id, order_date,
       order_status, coalesce(order_status <> 'Cancelled', false) AS is_revenue
FROM order_items LEFT JOIN shop_orders USING (order_id)"""))
def sales_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder).withColumn("line_total", F.col("line_total").cast("double"))


_SOLD = {"sold": "SELECT * FROM order_items JOIN (SELECT order_id, customer_id, company_id, "
                 "order_date FROM shop_orders WHERE order_status <> 'Cancelled') "
                 "USING (order_id)"}
_PLACED = {"placed": "SELECT * FROM (SELECT order_id, customer_id, company_id, order_date "
                     "FROM shop_orders WHERE order_status <> 'Cancelled') LEFT JOIN "
                     "(SELECT order_id, sum(line_total) AS line_total, sum(quantity) AS quantity "
                     "FROM order_items GROUP BY 1) USING (order_id)"}


@query(with_views("shop_orders order_items", """
SELECT strftime(order_date, '%Y-%m') AS month,
       CAST(coalesce(sum(line_total), 0) AS DOUBLE) AS revenue,
       CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units, count(*) AS orders
FROM placed GROUP BY 1""", **_PLACED))
def revenue_by_month(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.revenue_by_month(_placed(spark, folder))
    return found.select("month", *as_double("revenue"), "units", "orders")


@query(with_views("shop_orders order_items products categories", """
SELECT category_name, CAST(sum(line_total) AS DOUBLE) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT product_id) AS products
FROM sold LEFT JOIN products USING (product_id) LEFT JOIN categories USING (category_id) GROUP BY 1
""", **_SOLD))
def revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.revenue_by_category(
        _sales(spark, folder), *shop.load(spark, folder, "products", "categories"))
    return found.select("category_name", *as_double("revenue"), "units", "products")


@query(with_views("shop_orders order_items", """
SELECT product_id, CAST(sum(line_total) AS DOUBLE) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units FROM sold GROUP BY 1""", **_SOLD))
def revenue_by_product(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.revenue_by_product(_sales(spark, folder))
    return found.select("product_id", *as_double("revenue"), "units")


@query(with_views("shop_orders order_items companies", """
SELECT country, CAST(coalesce(sum(line_total), 0) AS DOUBLE) AS revenue, count(*) AS orders
FROM placed LEFT JOIN companies USING (company_id) GROUP BY 1""", **_PLACED))
def revenue_by_country(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.revenue_by_country(
        _placed(spark, folder), *shop.load(spark, folder, "companies"))
    return found.select("country", *as_double("revenue"), "orders")


@query(with_views("shop_orders order_items company_moves", """
SELECT country, CAST(sum(line_total) AS DOUBLE) AS revenue, count(*) AS orders
FROM placed p ASOF LEFT JOIN single s ON p.company_id = s.company_id AND p.order_date >= s.updated_at
GROUP BY country""", **_PLACED, single="""
SELECT company_id, updated_at, max(country) AS country FROM company_moves GROUP BY 1, 2"""))
def revenue_by_country_at_order(spark: SparkSession, folder: str) -> DataFrame:
    """By where the company was when it ordered, not by where it is now."""
    moved = history.scd2(shop.company_moves(spark, folder), ["company_id"], "updated_at", ["country"])
    dated = marts.at_company_version(_placed(spark, folder), moved)
    return marts.revenue_by_country_at_order(dated).select("country", *as_double("revenue"), "orders")


@query(with_views("shop_orders order_items", """
SELECT count(*) AS orders, CAST(sum(line_total) AS DOUBLE) AS revenue,
       CAST(sum(line_total) AS DOUBLE) / count(*) AS average_order_value
FROM placed""", **_PLACED))
def average_order_value(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.average_order_value(_placed(spark, folder))
    return found.select("orders", *as_double("revenue"), "average_order_value")


@query(with_views("shop_orders order_items customers", """
SELECT customer_id, count(DISTINCT order_id) AS orders,
       CAST(coalesce(sum(line_total), 0) AS DOUBLE) AS revenue,
       min(order_date) AS first_order, max(order_date) AS last_order
FROM customers LEFT JOIN (SELECT customer_id, order_id, line_total, order_date FROM placed)
     USING (customer_id) GROUP BY 1""", **_PLACED))
def customer_lifetime_value(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.customer_lifetime_value(
        *shop.load(spark, folder, "customers"), _placed(spark, folder))
    return found.withColumn("revenue", F.col("revenue").cast("double"))


@query(with_views("shop_orders", """
SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
       CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE) / count(*) AS repeat_share
FROM (SELECT customer_id, count(*) AS n FROM shop_orders WHERE order_status <> 'Cancelled'
      GROUP BY 1)"""))
def repeat_customers(spark: SparkSession, folder: str) -> DataFrame:
    return marts.repeat_customers(*shop.load(spark, folder, "orders"))


@query(with_views("web_logs", """
SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS requests,
       CAST(sum(bytes_sent) AS BIGINT) AS bytes_sent, count(DISTINCT auth_user) AS users
FROM web_logs GROUP BY 1"""))
def traffic_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return marts.traffic_by_day(*shop.load(spark, folder, "web_logs"))


@query(with_views("web_logs", """
SELECT request_path, count(*) AS requests, count(*) FILTER (WHERE status_code >= 400) AS errors,
       CAST(count(*) FILTER (WHERE status_code >= 400) AS DOUBLE) / count(*) AS error_rate
FROM web_logs GROUP BY 1"""))
def error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return marts.error_rate(*shop.load(spark, folder, "web_logs"))


@query(with_views("web_logs", """
SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS requests,
       count(*) FILTER (WHERE is_bot) AS bot_requests,
       CAST(count(*) FILTER (WHERE is_bot) AS DOUBLE) / count(*) AS bot_share
FROM web_logs GROUP BY 1"""))
def bot_share(spark: SparkSession, folder: str) -> DataFrame:
    return marts.bot_share(*shop.load(spark, folder, "web_logs"))


@query(with_views("marketing_leads", """
SELECT funnel_stage, count(*) AS leads,
       CAST(sum(estimated_order_value) AS DOUBLE) AS expected_value,
       CAST(sum(lead_score) AS DOUBLE) / count(*) AS mean_score
FROM marketing_leads GROUP BY 1"""))
def lead_funnel(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.lead_funnel(*shop.load(spark, folder, "marketing_leads"))
    return found.withColumn("expected_value", F.col("expected_value").cast("double"))


@query(with_views("shop_orders marketing_leads", """
SELECT funnel_stage, count(*) AS leads, count(*) FILTER (WHERE used) AS converted,
       CAST(count(*) FILTER (WHERE used) AS DOUBLE) / count(*) AS conversion_rate
FROM (SELECT funnel_stage, lead_id IN (SELECT lead_id FROM shop_orders WHERE lead_id IS NOT NULL)
             AS used FROM marketing_leads) GROUP BY 1"""))
def lead_conversion_rate(spark: SparkSession, folder: str) -> DataFrame:
    leads, orders = shop.load(spark, folder, "marketing_leads", "orders")
    return marts.lead_conversion_rate(leads, orders, "funnel_stage")


@query(with_views("shop_orders order_items suppliers", """
SELECT supplier_id, supplier_name, CAST(sum(line_total) AS DOUBLE) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units, nullif(count(product_id), 0) AS items,
       nullif(count(DISTINCT product_id), 0) AS products
FROM suppliers FULL JOIN sold USING (supplier_id) GROUP BY 1, 2""", **_SOLD))
def supplier_performance(spark: SparkSession, folder: str) -> DataFrame:
    found = marts.supplier_performance(
        _sales(spark, folder), *shop.load(spark, folder, "suppliers"))
    return found.withColumn("revenue", F.col("revenue").cast("double"))


@query("""
SELECT o_orderpriority AS pipeline_name, count(*) AS runs,
       count(*) FILTER (WHERE n > 0 AND o_orderstatus = 'P') AS failed_runs,
       CAST(count(*) FILTER (WHERE n > 0 AND o_orderstatus = 'P') AS DOUBLE) / count(*)
           AS failure_rate,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_extracted,
       CAST(coalesce(sum(units), 0) AS BIGINT) AS rows_loaded,
       round(avg(epoch(ended) - epoch(o_orderdate)), 6) AS mean_seconds
FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n, sum(l_quantity) AS units,
                              max(l_shipdate) AS ended FROM lineitem GROUP BY 1)
     USING (o_orderkey) GROUP BY 1""")
def pipeline_run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stand for runs: placed is started, last shipped is ended, cancelled is failed."""
    orders, items = (shop.read(spark, folder, t) for t in ("orders", "lineitem"))
    run = [F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("pipeline_name")]
    started = orders.select(*run, F.lit("started").alias("event"),
                            F.col("o_orderdate").alias("at"), F.lit("running").alias("status"))
    sent = items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("rows_extracted"), F.sum("l_quantity").alias("rows_loaded"),
        F.max("l_shipdate").alias("at"))
    ended = orders.join(sent, "o_orderkey").select(
        *run, F.lit("ended").alias("event"), "at", "rows_extracted", "rows_loaded",
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed").alias("status"))
    events = started.unionByName(ended, allowMissingColumns=True)
    metrics = journal.run_metrics(journal.run_log(accepted(conform(events, RUN_EVENTS))))
    return metrics.withColumn("mean_seconds", F.round("mean_seconds", 6))


@query(with_views("shop_orders order_items", """
SELECT order_id, customer_id, company_id, order_date, order_status,
       CAST(coalesce(amount, 0) AS DOUBLE) AS amount, CAST(coalesce(units, 0) AS BIGINT) AS units,
       order_status <> 'Cancelled' AS is_revenue
FROM shop_orders LEFT JOIN sums USING (order_id)
""", sums="SELECT order_id, sum(line_total) AS amount, sum(quantity) AS units "
          "FROM order_items GROUP BY 1"))
def order_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _placed(spark, folder).withColumn("amount", F.col("amount").cast("double"))


@query(with_views("shop_orders order_items", """
SELECT figure, CAST(sum(line_total) AS DOUBLE) AS revenue
FROM sold, (SELECT unnest(['month', 'country', 'category', 'product', 'supplier']) AS figure)
GROUP BY 1""", **_SOLD))
def revenue_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """The figures' totals, which add up to the same revenue."""
    placed, sales = _placed(spark, folder), _sales(spark, folder)
    companies, products, categories, suppliers = shop.load(
        spark, folder, "companies", "products", "categories", "suppliers")
    found = marts.revenue_reconciliation(
        marts.revenue_by_month(placed), marts.revenue_by_country(placed, companies),
        marts.revenue_by_category(sales, products, categories), marts.revenue_by_product(sales),
        marts.supplier_performance(sales, suppliers))
    return found.select("figure", *as_double("revenue"))
