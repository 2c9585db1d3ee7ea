"""Rules on all rows that share a key, whichever tables hold them.

A rule names figures of a key, each a fold over the rows of one table, and judges them. Rules of
one key are planned together: every table that holds the key gives its figures, folded before
the shuffle, to one grouping, whose groups are judged by all rules in one pass. So uniqueness,
references, children, totals, roles and dates of a key cost one shuffle of small rows, no
join, and a hot key is one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.operators.aggregates import union_all
from depotline.schemas import Table

_FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Figure:
    """A fold (sum, min or max) of a value, in SQL over a row, over the rows that hold a key."""

    table: str
    columns: tuple[str, ...]
    fold: str
    value: str


@dataclass(frozen=True)
class KeyRule:
    """``checked`` and ``failed`` are SQL per key; ``{name}`` in them stands for a figure."""

    rule: str
    table_name: str
    key: str
    figures: Mapping[str, Figure]
    checked: str
    failed: str


def _rows(table: str, *columns: str) -> Figure:
    return Figure(table, columns, "sum", "1")


def _pointing(table: str, column: str) -> Figure:
    return Figure(table, (column,), "sum", f"IF({column} IS NULL, 0, 1)")


def unique(table: str, columns: Sequence[str], key: str | None = None) -> KeyRule:
    """``failed`` counts the keys that occur more than once."""
    return KeyRule("_".join(columns) + "_unique", table, key or f"{table}.{','.join(columns)}",
                   {"rows": _rows(table, *columns)}, "{rows}", "IF({rows} > 1, 1, 0)")


def reference(child: str, foreign_key: str, parent: str, key: str) -> KeyRule:
    """``failed`` counts the child rows that point at no parent."""
    return KeyRule(f"{foreign_key}_reference", child, f"{parent}.{key}",
                   {"children": _pointing(child, foreign_key), "parents": _rows(parent, key)},
                   "{children}", "IF({parents} = 0, {children}, 0)")


def children_between(rule: str, parent: str, key: str, child: str, foreign_key: str, low: int,
                     high: int, where: str = "true") -> KeyRule:
    """``failed`` counts the parents, of those that ``where`` names, with too few or many children."""
    return KeyRule(rule, parent, f"{parent}.{key}",
                   {"children": _pointing(child, foreign_key),
                    "parents": Figure(parent, (key,), "sum", f"IF({where}, 1, 0)")},
                   "IF({parents} > 0, 1, 0)",
                   f"IF({{parents}} > 0 AND {{children}} NOT BETWEEN {low} AND {high}, 1, 0)")


def totals_agree(rule: str, parent: str, key: str, total: str, child: str, foreign_key: str,
                 amount: str) -> KeyRule:
    """``failed`` counts the parents with children whose amounts add up to another total."""
    return KeyRule(rule, parent, f"{parent}.{key}",
                   {"children": _pointing(child, foreign_key),
                    "total": Figure(parent, (key,), "min", total),
                    "amount": Figure(child, (foreign_key,), "sum", amount)},
                   "IF({children} > 0 AND {total} IS NOT NULL, 1, 0)",
                   "IF({children} > 0 AND {total} <> {amount}, 1, 0)")


def parent_meets(rule: str, child: str, foreign_key: str, parent: str, key: str,
                 condition: str) -> KeyRule:
    """``failed`` counts the child rows whose parent does not meet a condition."""
    return KeyRule(rule, child, f"{parent}.{key}",
                   {"children": _pointing(child, foreign_key), "parents": _rows(parent, key),
                    "meets": Figure(parent, (key,), "min", f"IF(coalesce({condition}, true), 1, 0)")},
                   "IF({parents} > 0, {children}, 0)",
                   "IF({parents} > 0 AND {meets} = 0, {children}, 0)")


def not_before(rule: str, child: str, foreign_key: str, at: str, parent: str, key: str,
               born: str) -> KeyRule:
    """``failed`` counts the parents that have a child dated before themselves."""
    return KeyRule(rule, child, f"{parent}.{key}",
                   {"first": Figure(child, (foreign_key,), "min", at),
                    "born": Figure(parent, (key,), "min", born)},
                   "IF({first} IS NOT NULL AND {born} IS NOT NULL, 1, 0)",
                   "IF({first} < {born}, 1, 0)")


def one_flagged(rule: str, table: str, column: str, flag: str, key: str) -> KeyRule:
    """``failed`` counts the groups without exactly one row that carries the flag."""
    return KeyRule(rule, table, key,
                   {"rows": _rows(table, column),
                    "flagged": Figure(table, (column,), "sum", f"IF({flag}, 1, 0)")},
                   "IF({rows} > 0, 1, 0)", "IF({rows} > 0 AND {flagged} <> 1, 1, 0)")


def of_table(table: Table) -> list[KeyRule]:
    """Uniqueness of a table's keys and its references."""
    rules = [unique(table.name, table.key, f"{table.name}.{table.key[0]}" if len(table.key) == 1 else None)]
    rules += [unique(table.name, columns) for columns in table.unique]
    return rules + [reference(table.name, fk, parent, key)
                    for fk, (parent, key) in table.references.items()]


def _judged(rules: Sequence[KeyRule], frames: Mapping[str, DataFrame]) -> DataFrame:
    """The rules of one key as rows."""
    figures = list(dict.fromkeys(f for r in rules for f in r.figures.values()))
    names = {f: f"_f{i}" for i, f in enumerate(figures)}
    branches: dict[tuple[str, tuple[str, ...]], list[Figure]] = {}
    for figure in figures:
        branches.setdefault((figure.table, figure.columns), []).append(figure)
    keys = [f"_k{i}" for i in range(len(figures[0].columns))]
    sides = [
        frames[table].select(*[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)],
                             *[F.expr(f.value).alias(names[f]) for f in own])
        for (table, columns), own in branches.items()
    ]
    met = sides[0]
    for side in sides[1:]:
        met = met.unionByName(side, allowMissingColumns=True)

    def folded(figure: Figure) -> Column:
        value = _FOLDS[figure.fold](names[figure])
        return (F.coalesce(value, F.lit(0)) if figure.fold == "sum" else value).alias(names[figure])

    groups = met.groupBy(*keys).agg(*[folded(f) for f in figures])

    def summed(sql: str, rule: KeyRule, name: str) -> Column:
        filled = sql.format(**{k: names[f] for k, f in rule.figures.items()})
        return F.expr(f"coalesce(sum(coalesce({filled}, 0)), 0)").cast("bigint").alias(name)

    sums = groups.agg(*[summed(sql, r, f"_{kind}{i}") for i, r in enumerate(rules)
                        for kind, sql in (("c", r.checked), ("n", r.failed))])
    listed = ", ".join(f"'{r.rule}', '{r.table_name}', _c{i}, _n{i}" for i, r in enumerate(rules))
    return sums.select(F.expr(
        f"stack({len(rules)}, {listed}) AS (rule, table_name, checked, failed)"))


def check_keys(rules: Iterable[KeyRule], frames: Mapping[str, DataFrame]) -> DataFrame:
    """All rules as rows (rule, table_name, checked, failed), with one grouping per key."""
    by_key: dict[str, list[KeyRule]] = {}
    for rule in rules:
        by_key.setdefault(rule.key, []).append(rule)
    return union_all([_judged(group, frames) for group in by_key.values()])
