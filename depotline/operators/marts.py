"""Star schema and key figures.

Two facts carry the figures. The order fact sums items per order before orders are
joined, so a hot order is one row. The sales fact joins items to orders as rows, a
join whose hot keys Spark splits. Figures are one grouping of a fact; dimensions
are joined to sums, never to single rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.functions.numbers import ratio
from depotline.functions.times import day_of, month_of
from depotline.operators.aggregates import union_all
from depotline.operators.history import as_of_join

CANCELLED = "Cancelled"


def sold(orders: DataFrame) -> DataFrame:
    """Orders that count as revenue."""
    return orders.where(F.col("order_status") != CANCELLED)


def counted(name: str = "rows") -> Column:
    return F.count(F.lit(1)).alias(name)


def conversion(leads: DataFrame, orders: DataFrame) -> DataFrame:
    """Leads with ``conversion_status``. A lead with several orders stays one row."""
    used = orders.where(F.col("lead_id").isNotNull()).select("lead_id").distinct()
    used = used.withColumn("_used", F.lit(True))
    status = F.when(F.col("_used"), "Converted").otherwise("Not Converted")
    return leads.join(used, "lead_id", "left").withColumn("conversion_status", status).drop("_used")


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    return products.join(categories.select("category_id", "category_name"), "category_id", "left")


def dim_customers(customers: DataFrame, companies: DataFrame) -> DataFrame:
    firms = companies.select("company_id", "company_name", "company_type", "country")
    return customers.join(firms, "company_id", "left")


def dim_suppliers(suppliers: DataFrame, companies: DataFrame) -> DataFrame:
    firms = companies.select("company_id", "company_type", "rating", "country")
    return suppliers.join(firms, "company_id", "left")


def placed_items(items: DataFrame, mapping: DataFrame) -> DataFrame:
    """Items with the supplier and product their pair stands for, NULL for an unknown pair."""
    pairs = mapping.select("supplier_product_id", "supplier_id", "product_id")
    return items.join(pairs, "supplier_product_id", "left")


def sales_fact(orders: DataFrame, items: DataFrame, item_key: str = "order_item_id") -> DataFrame:
    """One row per item with its order's keys, date and status.

    Items of cancelled orders and of none are kept and are no revenue.
    """
    heads = orders.select("order_id", "customer_id", "company_id", "order_date", "order_status")
    lines = items.select("order_id", item_key, "supplier_id", "product_id", "quantity",
                         "line_total")
    return lines.join(heads, "order_id", "left").withColumn(
        "is_revenue", F.coalesce(F.col("order_status") != CANCELLED, F.lit(False)))


def order_fact(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order with the ``amount`` and ``units`` of its items, zero without any."""
    sums = items.groupBy("order_id").agg(
        F.sum("line_total").alias("amount"), F.sum("quantity").alias("units"))
    heads = orders.select("order_id", "customer_id", "company_id", "order_date", "order_status")
    zero = F.lit(0)
    return (heads.join(sums, "order_id", "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("amount", "units")})
            .withColumn("is_revenue", F.coalesce(F.col("order_status") != CANCELLED, F.lit(False))))


def revenue_by_month(placed: DataFrame) -> DataFrame:
    return placed.where("is_revenue").groupBy(month_of(F.col("order_date")).alias("month")).agg(
        F.sum("amount").alias("revenue"), F.sum("units").alias("units"), counted("orders"))


def revenue_by_country(placed: DataFrame, companies: DataFrame) -> DataFrame:
    per_company = placed.where("is_revenue").groupBy("company_id").agg(
        F.sum("amount").alias("amount"), counted("orders"))
    return per_company.join(companies.select("company_id", "country"), "company_id", "left").groupBy(
        "country").agg(F.sum("amount").alias("revenue"), F.sum("orders").alias("orders"))


def at_company_version(placed: DataFrame, companies: DataFrame) -> DataFrame:
    """Orders with the ``country`` of their company at the time of the order, and since when it held.

    ``companies`` is the companies' history.
    """
    versions = companies.select("company_id", F.col("valid_from").alias("company_valid_from"), "country")
    return as_of_join(placed, versions, ["company_id"], "order_date", "company_valid_from",
                      ["company_valid_from", "country"])


def revenue_by_country_at_order(dated: DataFrame) -> DataFrame:
    """Revenue by the country that the company had when it ordered; NULL before its first version."""
    return dated.where("is_revenue").groupBy("country").agg(
        F.sum("amount").alias("revenue"), counted("orders"))


def revenue_by_product(sales: DataFrame) -> DataFrame:
    return sales.where("is_revenue").groupBy("product_id").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units"))


def revenue_by_category(sales: DataFrame, products: DataFrame,
                        categories: DataFrame) -> DataFrame:
    named = dim_products(products, categories).select("product_id", "category_name")
    return revenue_by_product(sales).join(named, "product_id", "left").groupBy("category_name").agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), counted("products"))


def revenue_reconciliation(month: DataFrame, country: DataFrame, category: DataFrame,
                           product: DataFrame, supplier: DataFrame) -> DataFrame:
    """Total revenue by each figure; the totals are equal."""
    views = {"month": month, "country": country, "category": category, "product": product,
             "supplier": supplier}
    return union_all([rows.agg(F.sum("revenue").alias("revenue")).select(
        F.lit(name).alias("figure"), "revenue") for name, rows in views.items()])


def average_order_value(placed: DataFrame) -> DataFrame:
    """One row: orders, revenue and revenue per order, cancelled ones left out."""
    sums = placed.where("is_revenue").agg(counted("orders"), F.sum("amount").alias("revenue"))
    return sums.withColumn("average_order_value", ratio(F.col("revenue"), F.col("orders")))


def customer_lifetime_value(customers: DataFrame, placed: DataFrame) -> DataFrame:
    """Orders, revenue, first and last order of every customer; zeros where there is none."""
    per_customer = placed.where("is_revenue").groupBy("customer_id").agg(
        counted("orders"), F.sum("amount").alias("revenue"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    return customers.select("customer_id").join(per_customer, "customer_id", "left").select(
        "customer_id",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("revenue", F.lit(0)).alias("revenue"),
        "first_order", "last_order")


def repeat_customers(orders: DataFrame) -> DataFrame:
    """One row: customers with an order, with more than one, and their share."""
    sizes = sold(orders).groupBy("customer_id").agg(counted("orders"))
    sums = sizes.agg(counted("customers"),
                     F.count_if(F.col("orders") > 1).alias("repeat_customers"))
    return sums.withColumn("repeat_share", ratio(F.col("repeat_customers"), F.col("customers")))


def traffic_by_day(logs: DataFrame) -> DataFrame:
    """Requests, bytes and distinct signed-in users per day."""
    return logs.groupBy(day_of(F.col("timestamp")).alias("day")).agg(
        counted("requests"), F.sum("bytes_sent").alias("bytes_sent"),
        F.count_distinct("auth_user").alias("users"))


def error_rate(logs: DataFrame) -> DataFrame:
    """Share of failed requests per path."""
    grouped = logs.groupBy("request_path").agg(
        counted("requests"), F.count_if(F.col("status_code") >= 400).alias("errors"))
    return grouped.withColumn("error_rate", ratio(F.col("errors"), F.col("requests")))


def bot_share(logs: DataFrame) -> DataFrame:
    """Share of bot requests per day."""
    grouped = logs.groupBy(day_of(F.col("timestamp")).alias("day")).agg(
        counted("requests"), F.count_if("is_bot").alias("bot_requests"))
    return grouped.withColumn("bot_share", ratio(F.col("bot_requests"), F.col("requests")))


def lead_funnel(leads: DataFrame) -> DataFrame:
    """Leads, expected value and mean score per stage."""
    grouped = leads.groupBy("funnel_stage").agg(
        counted("leads"), F.sum("estimated_order_value").alias("expected_value"),
        F.sum("lead_score").alias("_score"))
    return grouped.withColumn("mean_score", ratio(F.col("_score"), F.col("leads"))).drop("_score")


def lead_conversion_rate(leads: DataFrame, orders: DataFrame, by: str) -> DataFrame:
    """Share of converted leads per group."""
    grouped = conversion(leads, orders).groupBy(by).agg(
        counted("leads"),
        F.count_if(F.col("conversion_status") == "Converted").alias("converted"))
    return grouped.withColumn("conversion_rate", ratio(F.col("converted"), F.col("leads")))


def supplier_performance(sales: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Revenue, units, items and distinct products per supplier, cancelled orders left out.

    Suppliers without sales and sales of unknown suppliers are kept.
    """
    per_product = sales.where("is_revenue").groupBy("supplier_id", "product_id").agg(
        F.sum("line_total").alias("amount"), F.sum("quantity").alias("units"), counted("items"))
    per_supplier = per_product.groupBy("supplier_id").agg(
        F.sum("amount").alias("revenue"), F.sum("units").alias("units"),
        F.sum("items").alias("items"), counted("products"))
    return suppliers.select("supplier_id", "supplier_name").join(
        per_supplier, "supplier_id", "full")
