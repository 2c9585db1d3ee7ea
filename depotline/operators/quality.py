"""Data-quality rules.

Every check gives rows ``(rule, table_name, checked, failed)``. All row rules of a
table share one scan; all rules of a key, in whatever tables, share one grouping.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.operators import history
from depotline.operators.aggregates import union_all
from depotline.operators.keyrules import KeyRule, check_keys
from depotline.schemas import TABLES, Table


# Every column a registered table has, so that names in a rule can be told from functions.
_ALL_NAMES = {name: table.columns for name, table in TABLES.items()}


class QualityError(ValueError):
    """Raised by the gate; names the failed rules."""


def _quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def row_rules(table: Table) -> dict[str, str]:
    """The row rules of a registered table as SQL."""
    rules = {f"{c}_not_null": f"{c} IS NOT NULL" for c in table.required}
    rules |= {f"{c}_allowed": f"{c} IN ({_quoted(v)})" for c, v in table.allowed.items()}
    rules |= {f"{c}_length": f"length(CAST({c} AS STRING)) <= {n}" for c, n in table.lengths.items()}
    return rules | dict(table.checks)


def _columns_of(sql: str, columns: Iterable[str]) -> set[str]:
    """Which of the columns an expression names; texts in quotes are no names."""
    words = set(re.findall(r"\w+", re.sub(r"'(?:[^']|'')*'", " ", sql)))
    return words & set(columns)


def met(rule: str | Column) -> Column:
    """Is a rule met? As in a SQL CHECK, NULL counts as met."""
    if isinstance(rule, str):
        return F.expr(f"coalesce(({rule}), true)")
    return F.coalesce(rule, F.lit(True))


def failing_rows(rows: DataFrame, rule: str | Column) -> DataFrame:
    return rows.where(~met(rule))


def check_rows(rows: DataFrame, table_name: str, rules: Mapping[str, str | Column],
               bounds: tuple[int, int] | None = None) -> DataFrame:
    """Evaluate any number of row rules in one scan, and with ``bounds`` the row count as well."""
    failed = [
        F.expr(f"count_if(NOT coalesce(({r}), true)) AS _f{i}") if isinstance(r, str)
        else F.count_if(~met(r)).alias(f"_f{i}")
        for i, r in enumerate(rules.values())
    ]
    counted = rows.agg(F.count(F.lit(1)).alias("checked"), *failed)
    listed = [f"'{name}', _f{i}" for i, name in enumerate(rules)]
    if bounds is not None:
        listed.append(f"'row_count', IF(checked BETWEEN {bounds[0]} AND {bounds[1]}, 0L, 1L)")
    return counted.select(
        F.lit(table_name).alias("table_name"), "checked",
        F.expr(f"stack({len(listed)}, {', '.join(listed)}) AS (rule, failed)"),
    ).select("rule", "table_name", "checked", "failed")


def check_unique(rows: DataFrame, table_name: str, keys: Sequence[str],
                 rule: str | None = None) -> DataFrame:
    """``failed`` counts the keys that occur more than once."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
        F.count_if(F.col("_n") > 1).alias("failed"),
    ).select(F.lit(rule or "_".join(keys) + "_unique").alias("rule"),
             F.lit(table_name).alias("table_name"), "checked", "failed")


def check_reference(child: DataFrame, table_name: str, foreign_key: str, parent: DataFrame,
                    key: str, rule: str | None = None) -> DataFrame:
    """``failed`` counts the child rows that point at no parent.

    Child and parent keys are counted together in one grouping. Both sides shrink
    before the shuffle, so a hot reference costs one row per task.
    """
    pointing = child.where(F.col(foreign_key).isNotNull()).select(
        F.col(foreign_key).alias("_key"), F.lit(1).alias("_rows"), F.lit(0).alias("_parent"))
    present = parent.select(F.col(key).alias("_key"), F.lit(0).alias("_rows"),
                            F.lit(1).alias("_parent"))
    keys = pointing.unionAll(present).groupBy("_key").agg(
        F.sum("_rows").alias("_rows"), F.max("_parent").alias("_parent"))
    return keys.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_parent") == 0, F.col("_rows"))), F.lit(0)).alias("failed"),
    ).select(F.lit(rule or f"{foreign_key}_reference").alias("rule"),
             F.lit(table_name).alias("table_name"), "checked", "failed")


def check_count(rows: DataFrame, table_name: str, low: int, high: int,
                rule: str = "row_count") -> DataFrame:
    """``failed`` is 1 where the row count lies outside the bounds."""
    n = F.col("checked")
    return rows.agg(F.count(F.lit(1)).alias("checked")).select(
        F.lit(rule).alias("rule"), F.lit(table_name).alias("table_name"), "checked",
        F.when(n.between(low, high), 0).otherwise(1).cast("bigint").alias("failed"))


def child_counts(parent: DataFrame, key: str, child: DataFrame, foreign_key: str) -> DataFrame:
    """Number of children of every parent, 0 included: key, ``children``."""
    counts = child.groupBy(F.col(foreign_key).alias(key)).agg(
        F.count(F.lit(1)).alias("children"))
    return parent.select(key).join(counts, key, "left").select(
        key, F.coalesce("children", F.lit(0)).alias("children"))


def outside_bounds(parent: DataFrame, key: str, child: DataFrame, foreign_key: str,
                   low: int, high: int) -> DataFrame:
    """Parents with too few or too many children."""
    counts = child_counts(parent, key, child, foreign_key)
    return counts.where(~F.col("children").between(low, high))


def check_children(parent: DataFrame, table_name: str, key: str, child: DataFrame,
                   foreign_key: str, low: int, high: int, rule: str) -> DataFrame:
    """``failed`` counts the parents with too few or too many children."""
    counts = child_counts(parent, key, child, foreign_key)
    return check_rows(counts, table_name, {rule: f"children BETWEEN {low} AND {high}"})


def before_parent(child: DataFrame, foreign_key: str, at: str, parent: DataFrame, key: str,
                  born: str) -> DataFrame:
    """Child rows dated before the parent they point at; ``parent_at`` is the parent's date."""
    parents = parent.select(F.col(key).alias(foreign_key), F.col(born).alias("parent_at"))
    dated = child.where(F.col(foreign_key).isNotNull()).join(parents, foreign_key)
    return failing_rows(dated, F.col(at) >= F.col("parent_at"))


def check_parent(child: DataFrame, table_name: str, foreign_key: str, parent: DataFrame, key: str,
                 condition: str, rule: str) -> DataFrame:
    """``failed`` counts the child rows whose parent does not meet a condition.

    Children are counted per parent before the join.
    """
    counts = child.groupBy(F.col(foreign_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    judged = parent.select(F.col(key).alias("_key"), met(condition).alias("_met"))
    return counts.join(judged, "_key").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(~F.col("_met"), F.col("_n"))), F.lit(0)).alias("failed"),
    ).select(F.lit(rule).alias("rule"), F.lit(table_name).alias("table_name"), "checked", "failed")


def check_steps(versions: DataFrame, table_name: str, key: Sequence[str], at: str, status: str,
                allowed: Mapping[str, Sequence[str]], rule: str = "status_steps_legal") -> DataFrame:
    """``failed`` counts the steps between two versions of a row that are not allowed."""
    taken = history.steps(versions, key, at, status)
    return check_rows(taken, table_name, {rule: history.legal_step(allowed)})


def _unjudged(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    listed = ", ".join(f"'{rule}', '{table}'" for rule, table in rules)
    return spark.range(1).select(F.expr(f"stack({len(rules)}, {listed}) AS (rule, table_name)")).select(
        "rule", "table_name", F.lit(None).cast("bigint").alias("checked"),
        F.lit(None).cast("bigint").alias("failed"))


def _can_judge(rule: KeyRule, frames: Mapping[str, DataFrame]) -> bool:
    """Are all tables and columns that a key rule reads at hand?"""
    for figure in rule.figures.values():
        if figure.table not in frames:
            return False
        held = set(frames[figure.table].columns)
        if not held >= set(figure.columns):
            return False
        if _columns_of(figure.value, _ALL_NAMES.get(figure.table, ())) - held:
            return False
    return True


def quality_report(tables: Sequence[Table], frames: Mapping[str, DataFrame],
                   key_rules: Sequence[KeyRule] = (),
                   bounds: Mapping[str, tuple[int, int]] | None = None,
                   more: Sequence[DataFrame] = ()) -> DataFrame:
    """All rules of the given tables that are in ``frames``, as rows.

    ``key_rules`` are the rules across rows and tables, ``bounds`` the row counts that tables may
    have, ``more`` further results, such as those of ``check_steps``. A rule that reads a table or
    column that is not at hand has a row without counts; the gate does not pass it.
    """
    parts, left = [], []
    for table in tables:
        if table.name not in frames:
            continue
        rows, judged = frames[table.name], {}
        for name, sql in row_rules(table).items():
            if _columns_of(sql, table.columns) <= set(rows.columns):
                judged[name] = sql
            else:
                left.append((name, table.name))
        parts.append(check_rows(rows, table.name, judged, (bounds or {}).get(table.name)))
    shown = [r for r in key_rules if r.table_name in frames]
    ready = [r for r in shown if _can_judge(r, frames)]
    left += [(r.rule, r.table_name) for r in shown if r not in ready]
    if ready:
        parts.append(check_keys(ready, frames))
    if left:
        parts.append(_unjudged(next(iter(frames.values())).sparkSession, left))
    return union_all([*parts, *more])


def gate(report: DataFrame, unjudged: str = "raise") -> DataFrame:
    """Raise if any rule failed; nothing is to be loaded then.

    Rules without counts, which nobody could judge, raise as well unless ``unjudged`` is "pass".
    The report has one row per rule, so the failed ones fit the driver.
    """
    wrong = F.col("failed") > 0
    if unjudged == "raise":
        wrong = wrong | F.col("failed").isNull()
    failed = report.where(wrong).orderBy("table_name", "rule").collect()
    if failed:
        names = ", ".join(f"{r.table_name}.{r.rule} ({'not judged' if r.failed is None else r.failed})"
                          for r in failed)
        raise QualityError(f"failed rules: {names}")
    return report
