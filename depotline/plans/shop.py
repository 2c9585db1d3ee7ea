"""The shop's tables as views over the order and event tables.

Every view is a projection (two are groupings) of whole tables, so column pruning
and filters reach the scans. `SQL` holds the same views for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.functions.numbers import money
from depotline.schemas import COMPANY_SIZES, FUNNEL_STAGES
from depotline.session import written


# Layouts of the files, so that no read has to look one up.
_FILES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_FILES[name]).parquet(f"{folder}/{name}.parquet")


def _rating(balance: Column) -> Column:
    """A balance as a rating from 1.0 to 5.0."""
    points = F.round(money(balance) * F.lit("0.0005").cast("decimal(5,4)"), 1)
    bounded = F.greatest(F.lit("1.0").cast("decimal(2,1)"),
                         F.least(F.lit("5.0").cast("decimal(2,1)"), points))
    return bounded.cast("decimal(2,1)")


def companies(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))

    def role(table: str, prefix: str, key: str, kind: str) -> DataFrame:
        rows = read(spark, folder, table)
        rows = rows.join(nation, rows[f"{prefix}_nationkey"] == nation["n_nationkey"])
        return rows.select(
            F.concat(F.lit(prefix.upper()), F.col(key).cast("string")).alias("company_id"),
            F.col(f"{prefix}_name").alias("company_name"),
            F.lit(kind).alias("company_type"),
            _rating(F.col(f"{prefix}_acctbal")).alias("rating"),
            "country",
        )

    buyers = role("customer", "c", "c_custkey", "Buyer")
    sellers = role("supplier", "s", "s_suppkey", "Supplier")
    return buyers.unionAll(sellers)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("company_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("job_title"),
        F.expr("TIMESTAMP_NTZ '1992-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 2000 AS INT))")
        .alias("created_at"),
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("company_id"),
        F.col("s_name").alias("supplier_name"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    names = read(spark, folder, "part").select(F.col("p_type").alias("category_name")).distinct()
    return names.select(F.md5("category_name").alias("category_id"), "category_name")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.md5("p_type").alias("category_id"),
        F.col("p_brand").alias("brand"),
        money(F.col("p_retailprice")).alias("catalog_price"),
        (F.col("p_size") <= 45).alias("is_active"),
    )


# Prices and shares have two places, so a line is worked out in whole numbers and
# rounded half up; that is exact and cheaper than decimal division.
_PRICE = "cast(rint(l_extendedprice * 100) as bigint)"
_SHARE = "cast(rint(l_discount * 100) as bigint)"
_QUANTITY = "cast(l_quantity as bigint)"
_UNIT_CENTS = f"(2 * {_PRICE} + {_QUANTITY}) div (2 * {_QUANTITY})"
_DISCOUNT_CENTS = f"({_PRICE} * {_SHARE} + 50) div 100"
_TOTAL_CENTS = f"({_PRICE} * (100 - {_SHARE}) + 50) div 100"


def _amount(cents: Column) -> Column:
    """Whole cents as an amount."""
    return (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")


def supplier_product_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that were sold, at their lowest price; the product's cheapest are preferred."""
    pairs = (
        read(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("supplier_id"), F.col("l_partkey").alias("product_id"))
        .agg(_amount(F.min(F.expr(_UNIT_CENTS))).alias("supplier_price"))
    )
    cheapest = pairs.groupBy("product_id").agg(F.min("supplier_price").alias("_lowest"))
    return pairs.join(cheapest, "product_id").select(
        F.concat_ws("-", "supplier_id", "product_id").alias("supplier_product_id"),
        "supplier_id", "product_id", "supplier_price",
        (F.col("supplier_price") == F.col("_lowest")).alias("is_preferred_supplier"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("company_id"),
        F.when(priority == "1-URGENT", F.col("o_orderkey")).alias("lead_id"),
        F.col("o_orderdate").alias("order_date"),
        F.when(status == "F", "Delivered").when(status == "O", "Processing")
        .otherwise("Cancelled").alias("order_status"),
        F.when(priority == "5-LOW", "pending").when(priority == "4-NOT SPECIFIED", "refunded")
        .otherwise("paid").alias("payment_status"),
        money(F.col("o_totalprice")).alias("order_total"),
        F.col("o_orderdate").alias("updated_at"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.concat_ws("-", "l_suppkey", "l_partkey").alias("supplier_product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _amount(F.expr(_UNIT_CENTS)).alias("unit_price"),
        _amount(F.expr(_DISCOUNT_CENTS)).alias("discount_amount"),
        _amount(F.expr(_TOTAL_CENTS)).alias("line_total"),
        F.col("l_shipdate").alias("updated_at"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def marketing_leads(spark: SparkSession, folder: str) -> DataFrame:
    stages = F.array(*[F.lit(s) for s in FUNNEL_STAGES])
    sizes = F.array(*[F.lit(s) for s in COMPANY_SIZES])
    signups = read(spark, folder, "events").where(F.col("event_type") == "signup")
    k = F.col("_k")
    return signups.withColumn("_k", _k()).select(
        F.col("event_id").alias("lead_id"),
        F.concat(F.lit("NATION_"), F.floor(k / 3).cast("string")).alias("country"),
        F.element_at(sizes, F.floor(k / 20).cast("int") + 1).alias("company_size"),
        F.greatest(F.lit(1), F.least(F.lit(100), F.ceil("value"))).cast("int").alias("lead_score"),
        (money(F.col("value")) * 1000).cast("decimal(12,2)").alias("estimated_order_value"),
        F.element_at(stages, F.floor(k / 15).cast("int") + 1).alias("funnel_stage"),
        F.col("ts").alias("created_at"),
        # A few are changed before they are created.
        F.expr("ts + make_dt_interval(0, _k - 3)").alias("updated_at"),
    )


def web_logs(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").withColumn("is_bot", _k() < 5).select(
        F.col("event_id").alias("log_id"),
        F.col("ts").alias("timestamp"),
        F.when(~F.col("is_bot"), F.concat(F.lit("user"), F.col("user_id").cast("string")))
        .alias("auth_user"),
        F.concat(F.lit("/"), "event_type").alias("request_path"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        (money(F.col("value")) * 100).cast("int").alias("bytes_sent"),
        "is_bot",
    )


def company_versions(spark: SparkSession, folder: str) -> DataFrame:
    """What a company was at a time: the event type of a user stands for the tracked value."""
    return read(spark, folder, "events").select(
        F.col("user_id").alias("company_id"), F.col("ts").alias("updated_at"),
        F.col("event_type").alias("segment"), money(F.col("value")).alias("amount"),
    )


def company_moves(spark: SparkSession, folder: str) -> DataFrame:
    """Where a buyer was at a time; the events' month is spread over the years of the orders."""
    at = "TIMESTAMP_NTZ '1995-01-01 00:00:00' + (ts - TIMESTAMP_NTZ '2024-01-01 00:00:00') * 80"
    return read(spark, folder, "events").select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("company_id"),
        F.expr(at).alias("updated_at"),
        F.concat(F.lit("NATION_"), F.floor(_k() / 4).cast("string")).alias("country"))


TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "companies": companies,
    "categories": categories,
    "customers": customers,
    "suppliers": suppliers,
    "products": products,
    "supplier_product_mapping": supplier_product_mapping,
    "orders": orders,
    "order_items": order_items,
    "marketing_leads": marketing_leads,
    "web_logs": web_logs,
}


def load(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [TABLES[n](spark, folder) for n in names]


def load_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every table, for checks that read each several times.

    The mapping is grouped from all items, so it is written once.
    """
    frames = {n: build(spark, folder) for n, build in TABLES.items()}
    frames["supplier_product_mapping"] = written(frames["supplier_product_mapping"], "mapping")
    return frames


# --------------------------------------------------------------------------
# The same views in SQL.
# --------------------------------------------------------------------------

_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_QTY = "CAST(l_quantity AS BIGINT)"
# Half-up division of whole cents, as decimal division does it.
_SQL_UNIT = (f"CAST(((2 * {_CENTS} + {_QTY}) // (2 * {_QTY})) AS DECIMAL(14,0))"
             " * CAST(0.01 AS DECIMAL(3,2))")
_SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _sql_rating(column: str) -> str:
    return (f"CAST(greatest(CAST(1.0 AS DECIMAL(2,1)), least(CAST(5.0 AS DECIMAL(2,1)), "
            f"round(CAST({column} AS DECIMAL(12,2)) * CAST(0.0005 AS DECIMAL(5,4)), 1))) "
            "AS DECIMAL(2,1))")


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SQL: dict[str, str] = {
    "companies": f"""
        SELECT 'C' || c_custkey AS company_id, c_name AS company_name, 'Buyer' AS company_type,
               {_sql_rating('c_acctbal')} AS rating, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT 'S' || s_suppkey, s_name, 'Supplier', {_sql_rating('s_acctbal')}, n_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "customers": """
        SELECT c_custkey AS customer_id, 'C' || c_custkey AS company_id,
               c_name AS customer_name, c_mktsegment AS job_title,
               TIMESTAMP '1992-01-01' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS created_at
        FROM customer""",
    "suppliers": """
        SELECT s_suppkey AS supplier_id, 'S' || s_suppkey AS company_id,
               s_name AS supplier_name FROM supplier""",
    "categories": """
        SELECT DISTINCT md5(p_type) AS category_id, p_type AS category_name FROM part""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, md5(p_type) AS category_id,
               p_brand AS brand, CAST(p_retailprice AS DECIMAL(12,2)) AS catalog_price,
               p_size <= 45 AS is_active FROM part""",
    "supplier_product_mapping": f"""
        SELECT supplier_id || '-' || product_id AS supplier_product_id, supplier_id, product_id,
               supplier_price,
               supplier_price = min(supplier_price) OVER (PARTITION BY product_id)
                   AS is_preferred_supplier
        FROM (SELECT l_suppkey AS supplier_id, l_partkey AS product_id,
                     min({_SQL_UNIT}) AS supplier_price
              FROM lineitem GROUP BY l_suppkey, l_partkey)""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'C' || o_custkey AS company_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END AS lead_id,
               o_orderdate AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Processing'
                    ELSE 'Cancelled' END AS order_status,
               CASE o_orderpriority WHEN '5-LOW' THEN 'pending'
                    WHEN '4-NOT SPECIFIED' THEN 'refunded' ELSE 'paid' END AS payment_status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_total, o_orderdate AS updated_at
        FROM orders""",
    "order_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS line_number,
               l_suppkey || '-' || l_partkey AS supplier_product_id,
               l_suppkey AS supplier_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, {_SQL_UNIT} AS unit_price,
               round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
                   AS discount_amount,
               round(CAST(l_extendedprice AS DECIMAL(12,2))
                     * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS line_total,
               l_shipdate AS updated_at
        FROM lineitem""",
    "marketing_leads": f"""
        SELECT event_id AS lead_id, 'NATION_' || (k // 3) AS country,
               {_sql_list(COMPANY_SIZES)}[k // 20 + 1] AS company_size,
               CAST(greatest(1, least(100, ceil(value))) AS INTEGER) AS lead_score,
               CAST(CAST(value AS DECIMAL(12,2)) * 1000 AS DECIMAL(12,2)) AS estimated_order_value,
               {_sql_list(FUNNEL_STAGES)}[k // 15 + 1] AS funnel_stage,
               ts AS created_at, ts + to_hours(k - 3) AS updated_at
        FROM (SELECT *, {_SQL_K} AS k FROM events WHERE event_type = 'signup')""",
    "web_logs": f"""
        SELECT event_id AS log_id, ts AS "timestamp",
               CASE WHEN NOT is_bot THEN 'user' || user_id END AS auth_user,
               '/' || event_type AS request_path,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
               CAST(CAST(value AS DECIMAL(12,2)) * 100 AS INTEGER) AS bytes_sent, is_bot
        FROM (SELECT *, {_SQL_K} < 5 AS is_bot FROM events)""",
    "company_moves": f"""
        SELECT 'C' || user_id AS company_id,
               TIMESTAMP '1995-01-01' + (ts - TIMESTAMP '2024-01-01') * 80 AS updated_at,
               'NATION_' || ({_SQL_K} // 4) AS country FROM events""",
    "company_versions": """
        SELECT user_id AS company_id, ts AS updated_at, event_type AS segment,
               CAST(value AS DECIMAL(12,2)) AS amount FROM events""",
}


def with_views(names: str, query: str, **extra: str) -> str:
    """A query over the named views, and extra ones in order, as one SQL statement."""
    views = {n: SQL[n] for n in names.split()} | extra
    listed = ",\n".join(f"{name} AS ({body})" for name, body in views.items())
    return f"WITH {listed}\n{query}"
