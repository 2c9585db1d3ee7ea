"""Table readers and append sinks.

A source is a reader format and its options. Parquet and CSV folders have a path
per table; a database is the same reader with format ``jdbc``.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotline.functions.times import at as moment
from depotline.schemas import LOAD_DATE, LOADED_AT, TABLES


@dataclass(frozen=True)
class Source:
    """Where tables are extracted from.

    ``options`` go to the reader. ``per_table`` adds options for one table. A database table
    with ``partitionColumn`` and ``numPartitions`` is read in parallel: its bounds are asked for
    in one small query and turned into ranges. ``names`` maps a table to its name at the source.
    """

    root: str = ""
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    per_table: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The whole table with every column the source has."""
        name = self.names.get(table, table)
        if self.format == "jdbc":
            return self._read_database(spark, table, name)
        reader = spark.read.format(self.format).options(**self.options)
        return reader.options(**self.per_table.get(table, {})).load(f"{self.root}/{name}")

    def database_options(self, table: str) -> dict[str, str]:
        """Reader options of a database table; times without a zone stay so."""
        return {"preferTimestampNTZ": "true", **self.options, **self.per_table.get(table, {})}

    def _read_database(self, spark: SparkSession, table: str, name: str) -> DataFrame:
        options = self.database_options(table)
        column, parts = options.pop("partitionColumn", None), int(options.pop("numPartitions", 1))
        if column is None or parts < 2:
            return spark.read.format("jdbc").options(**options).option("dbtable", name).load()
        bounds = spark.read.format("jdbc").options(**options).option(
            "query", bounds_query(name, column)).load().first()
        ranges = range_predicates(column, bounds[0], bounds[1], parts)
        url = options.pop("url")
        return spark.read.jdbc(url, name, predicates=ranges, properties=options)


def bounds_query(name: str, column: str) -> str:
    """The one query that finds a table's bounds."""
    return f"SELECT min({column}) AS low, max({column}) AS high FROM {name}"


def _literal(value) -> str:
    if isinstance(value, (int, float)):
        return str(value)
    shown = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return "'" + shown.replace("'", "''") + "'"


def range_predicates(column: str, low, high, parts: int) -> list[str]:
    """Conditions that deal the rows into ranges between two bounds, each row to one of them.

    Bounds are numbers, dates or times. The outer ranges are open, so rows that come after the
    bounds were asked for are read too; NULL goes with the first. An empty table is one range.
    """
    if low is None or high is None or low == high or parts < 2:
        return ["1 = 1"]
    if isinstance(low, date) and not isinstance(low, datetime):
        parts = min(parts, (high - low).days)
    elif isinstance(low, int):
        parts = min(parts, high - low)
    width = high - low
    # Whole numbers stay whole; a date's step is whole days.
    cuts = [low + (width * i // parts if isinstance(low, int) else width * i / parts)
            for i in range(1, parts)]
    if isinstance(low, date) and not isinstance(low, datetime):
        cuts = [low + timedelta(days=width.days * i // parts) for i in range(1, parts)]
    if not cuts:
        return ["1 = 1"]
    shown = [_literal(c) for c in cuts]
    return [f"{column} < {shown[0]} OR {column} IS NULL",
            *(f"{column} >= {a} AND {column} < {b}" for a, b in itertools.pairwise(shown)),
            f"{column} >= {shown[-1]}"]


def extract(spark: SparkSession, source: Source, table: str,
            watermark: datetime | None = None, until: datetime | None = None,
            columns: Sequence[str] | None = None) -> DataFrame:
    """The listed columns; with a watermark only rows changed after it.

    The comparison is strict. Both bounds are plain column comparisons, so they
    reach the file scan or the database.
    """
    rows = source.read(spark, table)
    wanted = TABLES[table].columns if columns is None else columns
    return changed_since(rows.select(*wanted), watermark, until)


def changed_since(rows: DataFrame, watermark: datetime | None, until: datetime | None = None,
                  stamp: str = "updated_at") -> DataFrame:
    if watermark is not None:
        rows = rows.where(F.col(stamp) > moment(watermark))
    if until is not None:
        rows = rows.where(F.col(stamp) <= moment(until))
    return rows


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows known to the driver, as one task."""
    def literal(value, column: T.StructField):
        shown = value
        if isinstance(value, datetime):
            shown = value.isoformat(sep=" ")
        elif isinstance(value, date):
            shown = value.isoformat()
        return F.lit(shown).cast(column.dataType).alias(column.name)

    listed = [F.struct(*[literal(v, c) for v, c in zip(row, schema)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*listed)))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  format: str = "parquet") -> DataFrame:
    """A table that may not have been written yet; other read errors are raised."""
    try:
        return spark.read.format(format).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def staged_schema(schema: T.StructType) -> T.StructType:
    """Staging layout: the columns, the load stamp and the load date."""
    return T.StructType([
        *schema.fields,
        T.StructField(LOADED_AT, T.TimestampNTZType(), True),
        T.StructField(LOAD_DATE, T.DateType(), True),
    ])


def stamped(rows: DataFrame, loaded_at: datetime) -> DataFrame:
    """Add the load stamp, one value for the whole run, and its date."""
    return rows.withColumn(LOADED_AT, moment(loaded_at)).withColumn(
        LOAD_DATE, F.col(LOADED_AT).cast("date"))


def append(rows: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append by column name; a column the target lacks is left out.

    Staging is laid out by load date, so one day's load is one folder and an
    empty load writes no data file.
    """
    rows.select(*columns).write.mode("append").partitionBy(LOAD_DATE).parquet(path)


def append_to_source(frames: Mapping[str, DataFrame], source: Source) -> list[str]:
    """Append each registered table that is there to a source, by column name."""
    for name in (loaded := [n for n in TABLES if n in frames]):
        columns = [c for c in TABLES[name].columns if c in frames[name].columns]
        writer = frames[name].select(*columns).write.mode("append").format(source.format)
        writer = writer.options(**source.options)
        target = source.names.get(name, name)
        if source.format == "jdbc":
            writer.option("dbtable", target).save()
        else:
            writer.save(f"{source.root}/{target}")
    return loaded


def route(frames: Mapping[str, DataFrame], targets: Iterable[str],
          load: Callable[[str, DataFrame], int]) -> dict[str, int]:
    """Load each named table that is there; absent ones are skipped."""
    return {name: load(name, frames[name]) for name in targets if name in frames}
