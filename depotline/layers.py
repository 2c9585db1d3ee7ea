"""From staging to figures: intermediate, warehouse and marts.

Each table of a layer is written as a new version and read back before the next
layer is built on it, so no layer is computed twice and a lost executor costs one
table at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from depotline import pipelines
from depotline.functions.times import run_time
from depotline.operators import marts
from depotline.operators.history import latest_version, scd2
from depotline.schemas import EXTRACTED, LOADED_AT, SNAPSHOTS
from depotline.sources import versions
from depotline.state import journal

Frames = Mapping[str, DataFrame]
Builder = Callable[[Frames], DataFrame]

# What a company is known by over time.
TRACKED = ["company_name", "company_type", "rating", "country", "city", "address"]


def company_history(staged: DataFrame) -> DataFrame:
    """Of versions with one stamp the one loaded last counts, as for the newest row."""
    single = latest_version(staged, ["company_id", "updated_at"], [LOADED_AT])
    return scd2(single, ["company_id"], "updated_at", TRACKED)


WAREHOUSE: dict[str, Builder] = {
    "dim_companies": lambda t: company_history(t["company_versions"]),
    "dim_customers": lambda t: marts.dim_customers(t["customers"], t["companies"]),
    "dim_suppliers": lambda t: marts.dim_suppliers(t["suppliers"], t["companies"]),
    "dim_products": lambda t: marts.dim_products(t["products"], t["categories"]),
    "fact_sales": lambda t: marts.sales_fact(
        t["orders"], marts.placed_items(t["order_items"], t["supplier_product_mapping"])),
    "fact_orders": lambda t: marts.order_fact(t["orders"], t["order_items"]),
    # Each order at the version of its company that held then.
    "fact_orders_as_of": lambda t: marts.at_company_version(t["fact_orders"], t["dim_companies"]),
    "fact_leads": lambda t: marts.conversion(t["marketing_leads"], t["orders"]),
}

MARTS: dict[str, Builder] = {
    "revenue_by_month": lambda t: marts.revenue_by_month(t["fact_orders"]),
    "revenue_by_category": lambda t: marts.revenue_by_category(
        t["fact_sales"], t["products"], t["categories"]),
    "revenue_by_product": lambda t: marts.revenue_by_product(t["fact_sales"]),
    "revenue_by_country": lambda t: marts.revenue_by_country(t["fact_orders"], t["companies"]),
    "revenue_by_country_at_order": lambda t: marts.revenue_by_country_at_order(
        t["fact_orders_as_of"]),
    "average_order_value": lambda t: marts.average_order_value(t["fact_orders"]),
    "customer_lifetime_value": lambda t: marts.customer_lifetime_value(
        t["customers"], t["fact_orders"]),
    "repeat_customers": lambda t: marts.repeat_customers(t["orders"]),
    "supplier_performance": lambda t: marts.supplier_performance(
        t["fact_sales"], t["suppliers"]),
    "lead_funnel": lambda t: marts.lead_funnel(t["marketing_leads"]),
    "lead_conversion_rate": lambda t: marts.lead_conversion_rate(
        t["marketing_leads"], t["orders"], "source"),
    "traffic_by_day": lambda t: marts.traffic_by_day(t["web_logs"]),
    "error_rate": lambda t: marts.error_rate(t["web_logs"]),
    "bot_share": lambda t: marts.bot_share(t["web_logs"]),
    "pipeline_run_metrics": lambda t: journal.run_metrics(t["runs"]),
}


def stored_name(layer: str, table: str) -> str:
    return f"{layer}.{table}"


def read(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A table of a layer as it was last built."""
    return versions.read_current(spark, root, stored_name(layer, table))


def _build(layer: str, builders: Mapping[str, Builder], inputs: Frames, root: str, version: str,
           at: datetime) -> dict[str, DataFrame]:
    """Tables of one layer in order; a later one may read an earlier one."""
    done: dict[str, DataFrame] = {}
    for name, build in builders.items():
        done[name] = versions.reload(build({**inputs, **done}), root, stored_name(layer, name),
                                     version, at)
    return done


def build(spark: SparkSession, root: str, staged: Sequence[str] = tuple(EXTRACTED),
          warehouse: Sequence[str] = tuple(WAREHOUSE), figures: Sequence[str] = tuple(MARTS),
          clock: Callable[[], datetime] = run_time) -> dict[str, DataFrame]:
    """Build the named warehouse tables and figures from staging; returns them as stored.

    ``staged`` names the staged tables they need.
    """
    version, at = uuid.uuid4().hex, clock()
    newest = {t: lambda _, t=t: pipelines.read_latest(spark, root, t) for t in staged}
    inputs = _build("intermediate", newest, {}, root, version, at)
    inputs |= {t: pipelines.read_snapshot(spark, root, t) for t in SNAPSHOTS}
    inputs["company_versions"] = pipelines.read_staged(spark, root, "companies")
    inputs["runs"] = journal.run_log(journal.read_events(spark, root))

    chosen = {n: WAREHOUSE[n] for n in warehouse}
    tables = _build("warehouse", chosen, inputs, root, version, at)
    wanted = {n: MARTS[n] for n in figures}
    return tables | _build("marts", wanted, inputs | tables, root, version, at)
