"""Facts and sums that follow staging: only what changed since the last refresh moves.

A refresh reads the staged rows that were loaded since the last one, merges them by key into the
stored newest rows, works out the facts of the orders they touch anew and changes the stored sums
by the difference. Tables are written as one new version and switched in one write, so a refresh
that dies leaves the last one whole, and its repetition starts from there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from depotline import pipelines
from depotline.functions.times import at as moment
from depotline.functions.times import run_time
from depotline.operators import marts
from depotline.operators.deltas import Sums, change, merged
from depotline.operators.history import latest_version
from depotline.schemas import LOAD_DATE, LOADED_AT, TABLES
from depotline.session import written
from depotline.sources import versions
from depotline.sources.tables import empty, staged_schema
from depotline.state import journal

PIPELINE = "refresh"
# Staged tables whose changes move the facts.
FOLLOWED = ["orders", "order_items", "supplier_product_mapping"]
FACTS = ["fact_orders", "fact_sales"]
_MONTH = "date_format(order_date, 'yyyy-MM')"
SUMS: dict[str, Sums] = {
    "revenue_by_month": Sums("fact_orders", {"month": _MONTH}, {"revenue": "amount", "units": "units"},
                             "is_revenue", rows="orders"),
    "revenue_by_company": Sums("fact_orders", {"company_id": "company_id"}, {"revenue": "amount"},
                               "is_revenue", rows="orders"),
    "revenue_by_customer": Sums("fact_orders", {"customer_id": "customer_id"}, {"revenue": "amount"},
                                "is_revenue", rows="orders"),
    "revenue_by_product": Sums("fact_sales", {"product_id": "product_id"},
                               {"revenue": "line_total", "units": "quantity"}, "is_revenue", rows="items"),
    "revenue_by_supplier": Sums("fact_sales", {"supplier_id": "supplier_id"},
                                {"revenue": "line_total", "units": "quantity"}, "is_revenue", rows="items"),
}


@dataclass(frozen=True)
class Refresh:
    """What one refresh did: staged rows read per table, orders touched, rows per table written."""

    read: Mapping[str, int]
    touched: int
    written: Mapping[str, int]


def stored_name(table: str) -> str:
    return f"refreshed.{table}"


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as the last refresh left it."""
    return versions.read_current(spark, root, stored_name(table))


def _staged_since(spark: SparkSession, root: str, table: str, since: datetime | None) -> DataFrame:
    """Staged rows loaded at or after a moment; folders of earlier days are not opened."""
    rows = pipelines.read_staged(spark, root, table)
    if since is None:
        return rows
    return rows.where((F.col(LOAD_DATE) >= moment(since).cast("date")) & (F.col(LOADED_AT) >= moment(since)))


def _among(rows: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is among the keys (left_semi) or not (left_anti); NULL is a key like others."""
    wanted = keys.select(*[F.col(k).alias(f"_key_{k}") for k in key])
    return rows.join(wanted, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key]), how)


def _ids(rows: DataFrame) -> DataFrame:
    return rows.select("order_id")


def refresh(spark: SparkSession, root: str, sums: Mapping[str, Sums] = SUMS,
            clock: Callable[[], datetime] = run_time) -> Refresh:
    """Bring newest rows, facts and sums up to date with staging.

    Rows loaded from the last refresh's mark on are read. The mark is the moment before which no
    run can load any more, so rows of a run that is under way are read again by the next refresh,
    which changes nothing: merging newest rows twice gives the same rows. Late rows and
    backdated versions are found by when they were loaded, not by their own stamp.
    """
    at, version = clock(), uuid.uuid4().hex
    old_mark = journal.read_marks(spark, root, PIPELINE)
    new_mark = journal.settled_until(spark, root, at)
    current = versions.current_versions(spark, root)
    run_id = journal.start_run(spark, root, PIPELINE, at)
    counts: dict[str, int] = {}

    def stored(table: str, schema) -> DataFrame:
        name = stored_name(table)
        if name not in current:
            return empty(spark, schema)
        return spark.read.schema(schema).parquet(versions.version_path(root, name, current[name]))

    def store(table: str, rows: DataFrame) -> DataFrame:
        seen = Observation()
        versions.write_version(rows.observe(seen, F.count(F.lit(1)).alias("n")), root,
                               stored_name(table), version)
        counts[stored_name(table)] = seen.get["n"]
        return spark.read.schema(rows.schema).parquet(
            versions.version_path(root, stored_name(table), version))

    try:
        seen: dict[str, int] = {}
        newest: dict[str, DataFrame] = {}
        before: dict[str, DataFrame] = {}
        after: dict[str, DataFrame] = {}
        for table in FOLLOWED:
            schema, key = staged_schema(TABLES[table].staging), TABLES[table].key
            rule = ["updated_at", LOADED_AT]
            watch = Observation()
            since = _staged_since(spark, root, table, old_mark.get(table)).observe(
                watch, F.count(F.lit(1)).alias("n"))
            delta = written(latest_version(since, key, rule), "refresh")
            seen[table] = watch.get["n"]
            held = stored(table, schema)
            before[table] = written(_among(held, delta, key, "left_semi"), "refresh")
            after[table] = written(latest_version(before[table].unionByName(delta), key, rule), "refresh")
            newest[table] = store(table, _among(held, delta, key, "left_anti").unionByName(after[table]))

        # Orders whose own row, items or items' pairs changed, by what they were and by what they are.
        pairs = after["supplier_product_mapping"].select("supplier_product_id")
        moved = newest["order_items"].join(pairs, "supplier_product_id", "left_semi")
        touched = written(_ids(after["orders"]).unionByName(_ids(before["order_items"]))
                          .unionByName(_ids(after["order_items"])).unionByName(_ids(moved)).distinct(), "refresh")

        order = ["order_id"]
        items = _among(newest["order_items"], touched, order, "left_semi")
        orders = _among(newest["orders"], touched, order, "left_semi")
        fresh = {
            "fact_orders": marts.order_fact(orders, items),
            "fact_sales": marts.sales_fact(orders, marts.placed_items(
                items, newest["supplier_product_mapping"])),
        }
        old: dict[str, DataFrame] = {}
        for fact in FACTS:
            fresh[fact] = written(fresh[fact], "refresh")
            held = stored(fact, fresh[fact].schema)
            old[fact] = _among(held, touched, order, "left_semi")
            store(fact, _among(held, touched, order, "left_anti").unionByName(fresh[fact]))
        for name, each in sums.items():
            moved = change(old[each.fact], fresh[each.fact], each)
            store(name, merged(stored(name, moved.schema), moved, each))

        versions.switch_all(spark, root, counts, version, at)
        journal.save_marks(spark, root, PIPELINE, run_id, at, old_mark,
                           {t: new_mark for t in FOLLOWED})
        found = Refresh(seen, touched.count(), dict(counts))
        journal.end_run(spark, root, run_id, PIPELINE, clock(), sum(seen.values()),
                        sum(counts.values()), new_mark, "completed")
    except Exception as error:
        journal.end_run(spark, root, run_id, PIPELINE, clock(), 0, 0, None, "failed", str(error))
        raise
    return found
