"""The shop's rules across rows and tables, driven by the registry and its fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from depotline.operators import keyrules
from depotline.operators.keyrules import KeyRule
from depotline.schemas import (
    BEHIND,
    CUSTOMERS_PER_COMPANY,
    ITEMS_PER_ORDER,
    SUPPLIERS_PER_PRODUCT,
    TABLES,
    Table,
)

_ANY = 2**31 - 1


def key_rules(tables: Sequence[Table] = tuple(TABLES.values())) -> list[KeyRule]:
    """Uniqueness and references of the given tables, and the shop's rules that show up under them."""
    named = {t.name for t in tables}
    across = [
        keyrules.reference("orders", "lead_id", "marketing_leads", "lead_id"),
        keyrules.children_between("customers_per_company", "companies", "company_id", "customers",
                                  "company_id", *CUSTOMERS_PER_COMPANY, "company_type = 'Buyer'"),
        keyrules.children_between("suppliers_per_product", "products", "product_id",
                                  "supplier_product_mapping", "product_id", *SUPPLIERS_PER_PRODUCT),
        keyrules.children_between("items_per_order", "orders", "order_id", "order_items", "order_id",
                                  *ITEMS_PER_ORDER),
        keyrules.children_between("order_has_items", "orders", "order_id", "order_items", "order_id",
                                  1, _ANY),
        keyrules.children_between("won_lead_has_one_order", "marketing_leads", "lead_id", "orders",
                                  "lead_id", 1, 1, "funnel_stage = 'Won'"),
        keyrules.totals_agree("total_is_sum_of_items", "orders", "order_id", "order_total",
                              "order_items", "order_id", "line_total"),
        keyrules.not_before("order_not_before_customer", "orders", "customer_id", "order_date",
                            "customers", "customer_id", "created_at"),
        keyrules.not_before("order_not_before_lead", "orders", "lead_id", "order_date",
                            "marketing_leads", "lead_id", "created_at"),
        keyrules.one_flagged("one_preferred_supplier", "supplier_product_mapping", "product_id",
                             "is_preferred_supplier", "products.product_id"),
        *(keyrules.parent_meets(rule, child, "company_id", "companies", "company_id", condition)
          for child, (rule, condition) in BEHIND.items()),
    ]
    own = [rule for table in tables for rule in keyrules.of_table(table)]
    return own + [rule for rule in across if rule.table_name in named]
