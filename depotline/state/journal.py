"""Watermarks and run log.

Both are append-only tables: a new watermark or the end of a run is one more row,
and the newest row counts. Nothing is updated in place, and an error while
writing is raised.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.functions.times import at as moment
from depotline.operators.aggregates import union_all
from depotline.schemas import LOADS, PROFILES, RUN_EVENTS, WATERMARKS
from depotline.sources.tables import literal_rows, read_or_empty


def _marks_path(root: str) -> str:
    return f"{root}/state/watermarks"


def _runs_path(root: str) -> str:
    return f"{root}/state/runs"


def _append(spark: SparkSession, rows: Sequence[tuple], schema, path: str) -> None:
    literal_rows(spark, rows, schema).write.mode("append").parquet(path)


# ---- watermarks ------------------------------------------------------------

def newest_marks(journal: DataFrame) -> DataFrame:
    """The watermark table: the newest mark of every pipeline and table."""
    return journal.groupBy("pipeline_name", "table_name").agg(
        F.max_by("last_extracted_at", F.struct("recorded_at", "run_id")).alias(
            "last_extracted_at"))


def read_marks_table(spark: SparkSession, root: str) -> DataFrame:
    """Every mark that was ever written."""
    return read_or_empty(spark, _marks_path(root), WATERMARKS)


def read_marks(spark: SparkSession, root: str, pipeline: str) -> dict[str, datetime]:
    """Mark per table of a pipeline; a table without one is not in the result."""
    journal = read_marks_table(spark, root)
    marks = newest_marks(journal.where(F.col("pipeline_name") == pipeline)).collect()
    return {m.table_name: m.last_extracted_at for m in marks}


def save_marks(spark: SparkSession, root: str, pipeline: str, run_id: str,
               recorded_at: datetime, old: Mapping[str, datetime],
               new: Mapping[str, datetime | None]) -> dict[str, datetime]:
    """Write the marks that moved and return them."""
    moved = {t: m for t, m in new.items() if m is not None and m != old.get(t)}
    if moved:
        rows = [(pipeline, t, m, recorded_at, run_id) for t, m in moved.items()]
        _append(spark, rows, WATERMARKS, _marks_path(root))
    return moved


def later_mark(old: datetime | None, latest: datetime | None) -> datetime | None:
    """The later of the old mark and the newest stamp read."""
    return max((m for m in (old, latest) if m is not None), default=None)


def next_marks(tables: Mapping[str, DataFrame], old: Mapping[str, datetime],
               stamp: str = "updated_at") -> DataFrame:
    """One row per table: ``old_mark``, ``new_mark``. A table without new rows keeps its mark."""
    def one(name: str, rows: DataFrame) -> DataFrame:
        before: Column = (moment(old[name]) if name in old
                          else F.lit(None).cast("timestamp_ntz"))
        fresh = rows if name not in old else rows.where(F.col(stamp) > before)
        return fresh.agg(F.max(stamp).alias("_latest")).select(
            F.lit(name).alias("table_name"), before.alias("old_mark"),
            F.greatest(before, F.col("_latest")).alias("new_mark"))

    return union_all([one(name, rows) for name, rows in tables.items()])


# ---- run log ---------------------------------------------------------------

INTERRUPTED = "interrupted: the next run found it without an end"


def start_run(spark: SparkSession, root: str, pipeline: str, at: datetime) -> str:
    """Record the start of a run and return its id.

    A pipeline has one run at a time. So an earlier run of it that has no end was killed; it is
    closed as failed in the same write.
    """
    run_id = uuid.uuid4().hex
    rows = [(run_id, pipeline, "started", at, None, None, None, "running", None)]
    for lost in open_runs(spark, root).where(F.col("pipeline_name") == pipeline).collect():
        rows.append((lost.run_id, pipeline, "ended", at, 0, 0, None, "failed", INTERRUPTED))
    _append(spark, rows, RUN_EVENTS, _runs_path(root))
    return run_id


def open_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs that were started and have no end yet: run_id, pipeline_name, run_started_at."""
    log = run_log(read_events(spark, root))
    return log.where(F.col("run_ended_at").isNull()).select("run_id", "pipeline_name", "run_started_at")


def settled_until(spark: SparkSession, root: str, at: datetime) -> datetime:
    """Before this moment no run can load rows any more: the earliest start of an open run, or ``at``."""
    earliest = open_runs(spark, root).agg(F.min("run_started_at")).first()[0]
    return at if earliest is None else min(at, earliest)


def end_run(spark: SparkSession, root: str, run_id: str, pipeline: str, at: datetime,
            rows_extracted: int, rows_loaded: int, watermark_used: datetime | None,
            status: str, error_message: str | None = None) -> None:
    row = (run_id, pipeline, "ended", at, rows_extracted, rows_loaded, watermark_used, status,
           error_message)
    _append(spark, [row], RUN_EVENTS, _runs_path(root))


def read_events(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, _runs_path(root), RUN_EVENTS)


def run_log(events: DataFrame) -> DataFrame:
    """One row per run; what an ended run reports replaces what its start reported."""
    ended = F.col("event") == "ended"
    order = F.struct(ended.cast("int"), F.col("at"))
    return events.groupBy("run_id").agg(
        F.max("pipeline_name").alias("pipeline_name"),
        F.min(F.when(~ended, F.col("at"))).alias("run_started_at"),
        F.max(F.when(ended, F.col("at"))).alias("run_ended_at"),
        F.max_by("rows_extracted", order).alias("rows_extracted"),
        F.max_by("rows_loaded", order).alias("rows_loaded"),
        F.max_by("watermark_used", order).alias("watermark_used"),
        F.max_by("status", order).alias("status"),
        F.max_by("error_message", order).alias("error_message"),
    )


def run_metrics(log: DataFrame) -> DataFrame:
    """Per pipeline: runs, failures, failure rate, rows and mean duration in seconds."""
    between = F.col("run_ended_at") - F.col("run_started_at")
    seconds = between.cast("interval second").cast("decimal(18,6)").cast("double")
    failed = F.col("status") == "failed"
    return log.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(failed).alias("failed_runs"),
        (F.count_if(failed) / F.count(F.lit(1))).alias("failure_rate"),
        F.coalesce(F.sum("rows_extracted"), F.lit(0)).alias("rows_extracted"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.avg(seconds).alias("mean_seconds"),
    )


# ---- loads and profiles ----------------------------------------------------

def record_load(spark: SparkSession, root: str, run_id: str, table: str, loaded_at: datetime,
                rows_extracted: int, rows_loaded: int, unstamped: int, first: datetime | None,
                last: datetime | None, columns: Sequence[tuple[str, str, int]]) -> None:
    """What one load wrote, with the range of its stamps, and the profile of what it read.

    ``columns`` holds name, type and filled values of every column that was read.
    """
    row = (run_id, table, loaded_at, loaded_at.date(), rows_extracted, rows_loaded, unstamped, first, last)
    _append(spark, [row], LOADS, f"{root}/state/loads")
    if columns:
        listed = [(run_id, table, loaded_at, i, name, kind, rows_extracted, filled, rows_extracted - filled)
                  for i, (name, kind, filled) in enumerate(columns, 1)]
        _append(spark, listed, PROFILES, f"{root}/state/profiles")


def read_loads(spark: SparkSession, root: str) -> DataFrame:
    """One row per load of a table."""
    return read_or_empty(spark, f"{root}/state/loads", LOADS)


def read_profiles(spark: SparkSession, root: str) -> DataFrame:
    """One row per load and column: type, rows, filled and missing values."""
    return read_or_empty(spark, f"{root}/state/profiles", PROFILES)


def run_shapes(profiles: DataFrame) -> DataFrame:
    """Rows and columns per load."""
    return profiles.groupBy("run_id", "table_name").agg(
        F.max("row_count").alias("row_count"), F.count(F.lit(1)).alias("column_count"))


def load_days(spark: SparkSession, root: str, table: str, first: datetime, last: datetime) -> list:
    """Days whose loads of a table hold a stamp within a range, or rows without a stamp.

    One row per day of loading reaches the driver.
    """
    meets = (F.col("first_stamp") <= moment(last)) & (F.col("last_stamp") >= moment(first))
    days = read_loads(spark, root).where((F.col("table_name") == table) & (
        F.coalesce(meets, F.lit(False)) | (F.col("unstamped") > 0)))
    return [r.load_date for r in days.select("load_date").distinct().collect()]
