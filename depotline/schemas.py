"""Tables, keys, references and rules of the shop.

Everything here is declarative: readers, sinks and checks are driven by it, so a
table that is added to the registry is extracted, staged and checked as well.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Domain lists, ranges and table layouts that results depend on.
# --------------------------------------------------------------------------

COMPANY_TYPES = ["Buyer", "Supplier"]
ORDER_STATUSES = ["Pending", "Confirmed", "Processing", "Shipped", "Delivered", "Cancelled"]
PAYMENT_STATUSES = ["pending", "paid", "failed", "refunded"]
GENDERS = ["Male", "Female"]
FUNNEL_STAGES = ["New", "Contacted", "Qualified", "Proposal", "Negotiation", "Won", "Lost"]
COMPANY_SIZES = ["1-10", "11-50", "51-200", "201-500", "500+"]

# Lowest and highest lead score of a funnel stage.
STAGE_SCORES = {
    "New": (1, 16),
    "Contacted": (17, 32),
    "Qualified": (33, 48),
    "Proposal": (49, 64),
    "Negotiation": (65, 80),
    "Won": (81, 100),
    "Lost": (1, 80),
}

# Lowest and highest estimated order value of a company size.
SIZE_VALUES = {
    "1-10": (1_000, 10_000),
    "11-50": (10_000, 50_000),
    "51-200": (50_000, 150_000),
    "201-500": (150_000, 500_000),
    "500+": (500_000, 2_000_000),
}

# Order status reached from an order status. Processing has two ways on.
NEXT_STATUS = {
    "Processing": ["Confirmed", "Cancelled"],
    "Confirmed": ["Shipped"],
    "Shipped": ["Delivered"],
}

# Children per parent.
CUSTOMERS_PER_COMPANY = (10, 80)
SUPPLIERS_PER_PRODUCT = (2, 5)
ITEMS_PER_ORDER = (1, 5)

_STAMPS = "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"

_SOURCE = {
    "companies": "company_id STRING, company_name STRING, company_type STRING, cuit_tax_id STRING, "
    f"rating DECIMAL(2,1), country STRING, city STRING, address STRING, {_STAMPS}",
    "categories": f"category_id STRING, category_name STRING, {_STAMPS}",
    "customers": "customer_id STRING, company_id STRING, first_name STRING, last_name STRING, "
    "email STRING, phone_number STRING, gender STRING, date_of_birth DATE, job_title STRING, "
    f"{_STAMPS}",
    "suppliers": "supplier_id STRING, company_id STRING, supplier_name STRING, "
    f"contact_name STRING, email STRING, phone_number STRING, {_STAMPS}",
    "products": "product_id STRING, sku STRING, product_name STRING, category_id STRING, "
    "brand STRING, variant STRING, cost_price DECIMAL(12,2), catalog_price DECIMAL(12,2), "
    f"is_active BOOLEAN, {_STAMPS}",
    "supplier_product_mapping": "supplier_product_id STRING, supplier_id STRING, "
    "product_id STRING, supplier_price DECIMAL(12,2), lead_time_days INT, "
    f"is_preferred_supplier BOOLEAN, {_STAMPS}",
    "orders": "order_id STRING, customer_id STRING, company_id STRING, lead_id STRING, "
    "order_date TIMESTAMP_NTZ, order_status STRING, payment_status STRING, "
    f"order_total DECIMAL(12,2), {_STAMPS}",
    "order_items": "order_item_id STRING, order_id STRING, supplier_product_id STRING, "
    "quantity INT, unit_price DECIMAL(12,2), discount_amount DECIMAL(12,2), "
    f"line_total DECIMAL(12,2), {_STAMPS}",
    "marketing_leads": "lead_id STRING, source STRING, campaign_name STRING, utm_source STRING, "
    "utm_medium STRING, utm_campaign STRING, company_name STRING, company_size STRING, "
    "industry STRING, country STRING, city STRING, lead_score INT, "
    f"estimated_order_value DECIMAL(12,2), funnel_stage STRING, {_STAMPS}",
    "web_logs": "log_id STRING, country STRING, city STRING, timestamp TIMESTAMP_NTZ, "
    "client_ip STRING, auth_user STRING, session_id STRING, http_method STRING, "
    "request_path STRING, status_code INT, bytes_sent INT, referer STRING, device_type STRING, "
    "browser STRING, is_bot BOOLEAN",
}

# Staging keeps these amounts narrower than the source does.
_NARROWED = {
    "products": ["cost_price", "catalog_price"],
    "supplier_product_mapping": ["supplier_price"],
    "order_items": ["unit_price", "discount_amount", "line_total"],
}
_STAGED_AMOUNT = T.DecimalType(10, 2)

# Text lengths of the staging columns.
_LENGTHS = {
    "companies": {"company_id": 32, "company_name": 200, "company_type": 20, "cuit_tax_id": 20,
                  "country": 100, "city": 100, "address": 255},
    "categories": {"category_id": 32, "category_name": 150},
    "customers": {"customer_id": 32, "company_id": 32, "first_name": 100, "last_name": 100,
                  "email": 255, "phone_number": 20, "gender": 20, "job_title": 100},
    "suppliers": {"supplier_id": 32, "company_id": 32, "supplier_name": 200, "contact_name": 150,
                  "email": 255, "phone_number": 20},
    "products": {"product_id": 32, "sku": 50, "product_name": 200, "category_id": 32,
                 "brand": 100, "variant": 100},
    "supplier_product_mapping": {"supplier_product_id": 32, "supplier_id": 32, "product_id": 32},
    "orders": {"order_id": 32, "customer_id": 32, "company_id": 32, "lead_id": 32,
               "order_status": 30, "payment_status": 30},
    "order_items": {"order_item_id": 32, "order_id": 32, "supplier_product_id": 32},
    "marketing_leads": {"lead_id": 32, "source": 100, "campaign_name": 150, "utm_source": 100,
                        "utm_medium": 100, "utm_campaign": 150, "company_name": 200,
                        "company_size": 30, "industry": 100, "country": 100, "city": 100,
                        "funnel_stage": 30},
    "web_logs": {"log_id": 32, "country": 100, "city": 100, "client_ip": 45, "auth_user": 150,
                 "session_id": 32, "http_method": 10, "request_path": 255, "referer": 255,
                 "device_type": 30, "browser": 50},
}

_NULLABLE = {
    "customers": ["phone_number", "gender", "date_of_birth", "job_title"],
    "suppliers": ["contact_name", "phone_number"],
    "orders": ["lead_id"],
    "web_logs": ["auth_user"],
}

_UNIQUE = {
    "companies": [["company_name"], ["cuit_tax_id"]],
    "categories": [["category_name"]],
    "customers": [["email"]],
    "suppliers": [["email"]],
    "products": [["sku"]],
    "supplier_product_mapping": [["supplier_id", "product_id"]],
    "order_items": [["order_id", "supplier_product_id"]],
    "marketing_leads": [["company_name"]],
}

# column -> (parent table, parent key)
_REFERENCES = {
    "customers": {"company_id": ("companies", "company_id")},
    "suppliers": {"company_id": ("companies", "company_id")},
    "products": {"category_id": ("categories", "category_id")},
    "supplier_product_mapping": {"supplier_id": ("suppliers", "supplier_id"),
                                 "product_id": ("products", "product_id")},
    "orders": {"customer_id": ("customers", "customer_id"),
               "company_id": ("companies", "company_id")},
    "order_items": {"order_id": ("orders", "order_id"),
                    "supplier_product_id": ("supplier_product_mapping", "supplier_product_id")},
}

_ALLOWED = {
    "companies": {"company_type": COMPANY_TYPES},
    "customers": {"gender": GENDERS},
    "orders": {"order_status": ORDER_STATUSES, "payment_status": PAYMENT_STATUSES},
    "marketing_leads": {"company_size": COMPANY_SIZES, "funnel_stage": FUNNEL_STAGES},
}

# Row rules in SQL. As in a SQL CHECK, a rule that is NULL counts as met.
_CHECKS = {
    "companies": {"rating_range": "rating BETWEEN 1.0 AND 5.0"},
    "products": {"prices_not_negative": "catalog_price >= 0 AND cost_price >= 0",
                 "catalog_covers_cost": "catalog_price >= cost_price"},
    "supplier_product_mapping": {"price_not_negative": "supplier_price >= 0",
                                 "lead_time_not_negative": "lead_time_days >= 0"},
    "orders": {"total_not_negative": "order_total >= 0"},
    "order_items": {"quantity_positive": "quantity > 0",
                    "amounts_not_negative":
                        "unit_price >= 0 AND discount_amount >= 0 AND line_total >= 0"},
    "marketing_leads": {"score_range": "lead_score BETWEEN 1 AND 100"},
}

# Companies that customers, suppliers and orders may belong to.
BEHIND = {
    "customers": ("under_a_buyer", "company_type = 'Buyer'"),
    "suppliers": ("under_a_supplier", "company_type = 'Supplier'"),
    "orders": ("well_rated_buyer", "company_type = 'Buyer' AND rating >= 2.0"),
}

# ----------------------------- end of fixed values -------------------------

_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(2,1)": T.DecimalType(2, 1),
    "DECIMAL(12,2)": T.DecimalType(12, 2),
}


def layout(columns: str) -> T.StructType:
    """``name TYPE, name TYPE`` as a schema; needs no running session."""
    fields = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


LOADED_AT = "_loaded_at"
LOAD_DATE = "_load_date"


@dataclass(frozen=True)
class Table:
    """Layout and rules of one table."""

    name: str
    source: T.StructType
    staging: T.StructType
    key: list[str]
    nullable: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    allowed: dict[str, list[str]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.source.fieldNames()

    @property
    def required(self) -> list[str]:
        return [c for c in self.columns if c not in self.nullable]


def _staged(name: str, source: T.StructType) -> T.StructType:
    narrow = _NARROWED.get(name, [])
    return T.StructType(
        [
            T.StructField(f.name, _STAGED_AMOUNT if f.name in narrow else f.dataType, True)
            for f in source
        ]
    )


def _table(name: str) -> Table:
    source = layout(_SOURCE[name])
    checks = {**_CHECKS.get(name, {}), **_FORMULAS.get(name, {})}
    if "updated_at" in source.fieldNames():
        checks["updated_after_created"] = "updated_at >= created_at"
    return Table(
        name=name,
        source=source,
        staging=_staged(name, source),
        key=[source.fieldNames()[0]],
        nullable=_NULLABLE.get(name, []),
        unique=_UNIQUE.get(name, []),
        references=_REFERENCES.get(name, {}),
        allowed=_ALLOWED.get(name, {}),
        checks=checks,
        lengths=_LENGTHS[name],
    )


def _by_class(value: str, key: str, ranges: dict[str, tuple[int, int]]) -> str:
    """The range of a value by its class, as a row rule; an unknown class gives NULL."""
    arms = " ".join(f"WHEN '{k}' THEN {value} BETWEEN {lo} AND {hi}" for k, (lo, hi) in ranges.items())
    return f"CASE {key} {arms} END"


# Rules between columns of a row.
_FORMULAS = {
    "orders": {"payment_fits_status": "payment_status = CASE WHEN order_status IN ('Shipped', 'Delivered') "
                                      "THEN 'paid' ELSE 'pending' END"},
    "order_items": {"line_total_formula": "line_total = round(quantity * unit_price - discount_amount, 2)"},
    "marketing_leads": {"score_fits_stage": _by_class("lead_score", "funnel_stage", STAGE_SCORES),
                        "value_fits_size": _by_class("estimated_order_value", "company_size", SIZE_VALUES)},
}

TABLES: dict[str, Table] = {name: _table(name) for name in _SOURCE}

# The tables that are extracted by watermark, parents before children, and the
# two that arrive as whole CSV files.
EXTRACTED = ["companies", "categories", "customers", "suppliers", "products",
             "supplier_product_mapping", "orders", "order_items"]
SNAPSHOTS = ["marketing_leads", "web_logs"]

WATERMARKS = layout(
    "pipeline_name STRING, table_name STRING, last_extracted_at TIMESTAMP_NTZ, "
    "recorded_at TIMESTAMP_NTZ, run_id STRING"
)
RUN_EVENTS = layout(
    "run_id STRING, pipeline_name STRING, event STRING, at TIMESTAMP_NTZ, rows_extracted BIGINT, "
    "rows_loaded BIGINT, watermark_used TIMESTAMP_NTZ, status STRING, error_message STRING"
)
PROFILES = layout(
    "run_id STRING, table_name STRING, recorded_at TIMESTAMP_NTZ, position INT, column_name STRING, "
    "data_type STRING, row_count BIGINT, non_null BIGINT, missing BIGINT"
)
LOADS = layout(
    "run_id STRING, table_name STRING, loaded_at TIMESTAMP_NTZ, load_date DATE, rows_extracted BIGINT, "
    "rows_loaded BIGINT, unstamped BIGINT, first_stamp TIMESTAMP_NTZ, last_stamp TIMESTAMP_NTZ"
)
VERSIONS = layout(
    "table_name STRING, version STRING, recorded_at TIMESTAMP_NTZ, row_count BIGINT"
)
