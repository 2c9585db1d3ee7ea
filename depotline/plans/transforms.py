"""Enrichment, totals, distributions, sampling and text work on the shop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.functions import status, text
from depotline.functions.numbers import clamp, line_total, money
from depotline.functions.times import later_of, parse_timestamp
from depotline.operators import aggregates, joins, sampling
from depotline.plans import shop
from depotline.plans.registry import as_double, query
from depotline.plans.shop import with_views
from depotline.schemas import FUNNEL_STAGES

_SQL_STAGES = "['" + "', '".join(FUNNEL_STAGES) + "']"


@query(with_views("companies customers", """
SELECT customer_id, company_id, job_title, country
FROM customers LEFT JOIN companies USING (company_id)"""))
def enrich_country(spark: SparkSession, folder: str) -> DataFrame:
    customers, companies = shop.load(spark, folder, "customers", "companies")
    return joins.enrich(customers.drop("customer_name", "created_at"), companies, ["company_id"], ["country"])


@query(with_views("shop_orders order_items", """
SELECT order_id, order_status, CAST(items_total AS DOUBLE) AS items_total
FROM shop_orders LEFT JOIN sums USING (order_id)
""", sums="SELECT order_id, sum(line_total) AS items_total FROM order_items GROUP BY 1"))
def order_totals(spark: SparkSession, folder: str) -> DataFrame:
    orders, items = shop.load(spark, folder, "orders", "order_items")
    summed = joins.with_total(orders.select("order_id", "order_status"), "order_id",
                              items, "order_id", "line_total", "items_total")
    return summed.withColumn("items_total", F.col("items_total").cast("double"))


@query("""
SELECT 'event_type' AS column_name, event_type AS value, count(*) AS n FROM events GROUP BY 2
UNION ALL
SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2""")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = shop.read(spark, folder, "events")
    return aggregates.value_counts(events, ["event_type", "user_id"])


@query(with_views("marketing_leads", """
SELECT 'funnel_stage' AS column_name, funnel_stage AS value, count(*) AS n
FROM marketing_leads GROUP BY 2
UNION ALL
SELECT 'company_size', company_size, count(*) FROM marketing_leads GROUP BY 2
UNION ALL
SELECT 'country', country, count(*) FROM marketing_leads GROUP BY 2"""))
def lead_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    (leads,) = shop.load(spark, folder, "marketing_leads")
    return aggregates.value_counts(leads, ["funnel_stage", "company_size", "country"])


@query("""
SELECT count(*) AS groups, round(avg(size), 6) AS mean, round(stddev_samp(size), 6) AS std,
       min(size) AS min, quantile_cont(size, 0.25) AS q25, quantile_cont(size, 0.5) AS q50,
       quantile_cont(size, 0.75) AS q75, max(size) AS max
FROM (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1)""")
def group_size_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer."""
    (orders,) = shop.load(spark, folder, "orders")
    stats = aggregates.group_size_stats(orders, ["customer_id"])
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("""
SELECT count(DISTINCT l_orderkey) AS order_id, count(DISTINCT l_partkey) AS product_id,
       count(DISTINCT l_suppkey) AS supplier_id,
       count(DISTINCT l_suppkey || '-' || l_partkey) AS supplier_product_id FROM lineitem""")
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    (items,) = shop.load(spark, folder, "order_items")
    return aggregates.distinct_counts(
        items, ["order_id", "product_id", "supplier_id", "supplier_product_id"])


_SAMPLE, _SEED = 25, 40


@query(with_views("shop_orders", f"""
SELECT order_id, customer_id, order_status FROM shop_orders
ORDER BY md5(order_id || ':{_SEED}'), order_id LIMIT {_SAMPLE}"""))
def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    (orders,) = shop.load(spark, folder, "orders")
    drawn = orders.select("order_id", "customer_id", "order_status")
    return sampling.seeded_sample(drawn, "order_id", _SAMPLE, _SEED)


@query(with_views("companies customers marketing_leads", """
SELECT lead_id, country, customer_id
FROM (SELECT lead_id, l.country, coalesce(own, '*') AS pool,
             ('0x' || substr(md5(CAST(lead_id AS VARCHAR)), 1, 15))::BIGINT % size AS seat
      FROM marketing_leads l
      LEFT JOIN (SELECT DISTINCT country AS own FROM placed) ON own = l.country
      JOIN (SELECT pool, count(*) AS size FROM pooled GROUP BY 1) s ON s.pool = coalesce(own, '*'))
JOIN (SELECT pool, customer_id,
             row_number() OVER (PARTITION BY pool ORDER BY
                 substr(md5(CAST(customer_id AS VARCHAR)), 1, 4), customer_id) - 1 AS seat
      FROM pooled) USING (pool, seat)
""", placed="SELECT customer_id, country FROM customers JOIN companies USING (company_id)",
    pooled="SELECT country AS pool, customer_id FROM placed "
           "UNION ALL SELECT '*', customer_id FROM placed"))
def match_in_group(spark: SparkSession, folder: str) -> DataFrame:
    """Give each lead a customer of its country, or any customer if the country has none."""
    leads, customers, companies = shop.load(
        spark, folder, "marketing_leads", "customers", "companies")
    placed = joins.enrich(customers.select("customer_id", "company_id"), companies,
                          ["company_id"], ["country"])
    return joins.match_in_group(leads.select("lead_id", "country"), placed, "lead_id",
                                "customer_id", "country").select(
        "lead_id", "country", "customer_id")


@query(with_views("", """
SELECT id, replace(key_hex, '-', '') AS hex_id,
       translate(lower(first || '.' || last), ' -', '') AS user_name,
       translate(lower(first || '.' || last), ' -', '') || key || '@' ||
           translate(lower(regexp_extract(trim(name), '^[^\\s]+')), '-', '') || '.com' AS email,
       substr(regexp_replace(phone, '[^0-9]', '', 'g'), 1, 12) AS phone_number,
       length(substr(regexp_replace(phone, '[^0-9]', '', 'g'), 1, 12)) < 12 AS short_phone,
       translate(lower(name), ' ', '_') AS slug,
       first || ' ' || last AS full_name, name || ' Group' AS group_name, upper(brand) AS code
FROM texts""", texts="""
    SELECT p_partkey AS id, p_partkey AS key, p_name AS name, p_brand AS brand,
           split_part(p_name, ' ', 1) AS first, p_type || '-' || split_part(p_name, ' ', 2) AS last,
           substr(md5(p_name), 1, 8) || '-' || substr(md5(p_brand), 1, 4) AS key_hex,
           '+' || p_size || ' (' || p_partkey || ') ' || CAST(p_retailprice AS DECIMAL(12,2))
               || '-' || p_partkey AS phone
    FROM part"""))
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    part = shop.read(spark, folder, "part")
    key, name = F.col("p_partkey"), F.col("p_name")
    words = F.split(name, " ")
    first = words[0]
    last = F.concat(F.col("p_type"), F.lit("-"), words[1])
    phone = F.concat(F.lit("+"), F.col("p_size"), F.lit(" ("), key, F.lit(") "),
                     money(F.col("p_retailprice")).cast("string"), F.lit("-"), key)
    key_hex = F.concat(F.substring(F.md5(name), 1, 8), F.lit("-"),
                       F.substring(F.md5("p_brand"), 1, 4))
    user = text.user_name(first, last)
    return part.select(
        key.alias("id"),
        text.without_dashes(key_hex).alias("hex_id"),
        user.alias("user_name"),
        text.email_address(user, key, F.concat(text.first_word(name), F.lit(".com")))
        .alias("email"),
        text.phone_digits(phone).alias("phone_number"),
        text.is_short_phone(phone).alias("short_phone"),
        text.slug(name).alias("slug"),
        text.full_name(first, last).alias("full_name"),
        text.with_suffix(name, "Group").alias("group_name"),
        text.upper_code(F.col("p_brand")).alias("code"),
    )


@query("""
SELECT c_custkey AS customer_id,
       CAST(greatest(1, least(5, CAST(c_acctbal AS DECIMAL(12,2))
            * CAST(0.001 AS DECIMAL(4,3)))) AS DOUBLE) AS clamped,
       CAST(round(CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)), 2) AS DOUBLE)
           AS rounded
FROM customer""")
def clamp_and_round(spark: SparkSession, folder: str) -> DataFrame:
    points = money(F.col("c_acctbal")) * F.lit("0.001").cast("decimal(4,3)")
    return shop.read(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        clamp(points, 1, 5).cast("double").alias("clamped"),
        F.round(points, 2).cast("double").alias("rounded"),
    )


@query(with_views("order_items", """
SELECT order_id, line_number,
       CAST(round(quantity * unit_price - discount_amount, 2) AS DOUBLE) AS line_total
FROM order_items"""))
def line_totals(spark: SparkSession, folder: str) -> DataFrame:
    (items,) = shop.load(spark, folder, "order_items")
    total = line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_amount"))
    return items.select("order_id", "line_number", total.cast("double").alias("line_total"))


@query("""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       greatest(o_orderdate, l_shipdate) AS later, TRY_CAST(l_shipdate::VARCHAR AS TIMESTAMP)
           AS parsed, TRY_CAST(l_returnflag AS TIMESTAMP) AS unparsed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def later_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    items, orders = (shop.read(spark, folder, t) for t in ("lineitem", "orders"))
    both = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    return both.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        later_of(F.col("o_orderdate"), F.col("l_shipdate")).alias("later"),
        parse_timestamp(F.col("l_shipdate").cast("string")).alias("parsed"),
        parse_timestamp(F.col("l_returnflag")).alias("unparsed"),
    )


@query(with_views("marketing_leads", f"""
SELECT lead_id, funnel_stage, list_position(stages, funnel_stage) AS stage_rank,
       array_to_string(list_slice(stages, list_position(stages, funnel_stage) + 1, 7), ',')
           AS later_stages,
       array_to_string(list_filter(stages, lambda s: s <> funnel_stage), ',') AS other_stages
FROM (SELECT *, {_SQL_STAGES} AS stages FROM marketing_leads)"""))
def stages_after(spark: SparkSession, folder: str) -> DataFrame:
    (leads,) = shop.load(spark, folder, "marketing_leads")
    stage = F.col("funnel_stage")
    return leads.select(
        "lead_id", "funnel_stage", status.stage_rank(stage).alias("stage_rank"),
        F.concat_ws(",", status.stages_after(stage)).alias("later_stages"),
        F.concat_ws(",", status.others(FUNNEL_STAGES, stage)).alias("other_stages"),
    )


@query(with_views("shop_orders", """
SELECT order_status, next_status, count(*) AS orders, CAST(sum(order_total) AS DOUBLE) AS total
FROM (SELECT *, CASE WHEN order_status = 'Processing' AND order_total < 50000 THEN 'Cancelled'
                     WHEN order_status = 'Processing' THEN 'Confirmed'
                     WHEN order_status = 'Confirmed' THEN 'Shipped'
                     WHEN order_status = 'Shipped' THEN 'Delivered'
                     ELSE order_status END AS next_status FROM shop_orders)
GROUP BY ALL"""))
def next_status(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and value per step to the next status; small open orders are cancelled."""
    (orders,) = shop.load(spark, folder, "orders")
    step = status.next_status(F.col("order_status"), cancel=F.col("order_total") < 50000)
    stepped = orders.withColumn("next_status", step).groupBy("order_status", "next_status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_total").alias("total"))
    return stepped.select("order_status", "next_status", "orders", *as_double("total"))
