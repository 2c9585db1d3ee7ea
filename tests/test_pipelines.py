"""Runs against real folders: first, second and empty runs, failures and repairs."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from depotline import pipelines
from depotline.operators import quality
from depotline.schemas import RUN_EVENTS, TABLES
from depotline.sources import csv_files, versions
from depotline.sources.tables import Source, append_to_source, bounds_query, extract, range_predicates
from depotline.state import journal
from depotline.streaming import arrivals

T0 = datetime(2024, 1, 1)


def hour(n):
    return T0 + timedelta(hours=n)


def orders(spark, rows):
    """(id, status, hour of update) as order rows."""
    return spark.createDataFrame(
        [(i, "u1", "c1", None, T0, s, "paid", Decimal("1.00"), T0, hour(h)) for i, s, h in rows],
        TABLES["orders"].source)


def categories(spark, rows):
    return spark.createDataFrame([(i, n, T0, hour(h)) for i, n, h in rows],
                                 TABLES["categories"].source)


def put(frame, source, table):
    frame.write.mode("overwrite").parquet(f"{source.root}/{table}")


def statuses(spark, root):
    return {r.order_id: r.order_status for r in pipelines.read_latest(spark, root, "orders").collect()}


def log(spark, root):
    return journal.run_log(journal.read_events(spark, root)).orderBy("run_started_at").collect()


@pytest.fixture
def source(root):
    return Source(root=f"{root}/source")


def run(spark, source, root, **more):
    return pipelines.run_extract(spark, source, root, tables=["orders"], **more)


def test_first_second_and_unchanged_run(spark, source, root):
    put(orders(spark, [("1", "Pending", 1), ("2", "Pending", 2)]), source, "orders")
    run(spark, source, root)
    put(orders(spark, [("1", "Pending", 1), ("2", "Shipped", 5), ("3", "Pending", 4)]), source,
        "orders")
    run(spark, source, root)
    run(spark, source, root)
    assert [(r.status, r.rows_extracted, r.rows_loaded) for r in log(spark, root)] == [
        ("completed", 2, 2), ("completed", 2, 2), ("completed", 0, 0)]
    assert statuses(spark, root) == {"1": "Pending", "2": "Shipped", "3": "Pending"}
    assert pipelines.read_staged(spark, root, "orders").count() == 4
    assert journal.read_marks(spark, root, "table_extract") == {"orders": hour(5)}
    assert journal.read_marks_table(spark, root).count() == 2


def test_the_mark_itself_is_not_read_again(spark, source, root):
    put(orders(spark, [("1", "Pending", 1), ("2", "Pending", 2)]), source, "orders")
    assert [r.order_id for r in extract(spark, source, "orders", hour(1)).collect()] == ["2"]
    assert extract(spark, source, "orders", None, hour(1)).count() == 1
    assert extract(spark, source, "orders").columns == TABLES["orders"].columns


def test_one_load_stamp_per_run(spark, source, root):
    put(orders(spark, [("1", "Pending", 1), ("2", "Pending", 2)]), source, "orders")
    run(spark, source, root, clock=lambda: hour(100))
    (row,) = pipelines.read_staged(spark, root, "orders").select(
        "_loaded_at", "_load_date").distinct().collect()
    assert row["_loaded_at"] == hour(100) and row["_load_date"] == hour(100).date()


def test_a_failure_between_tables_is_absorbed_on_retry(spark, source, root):
    put(categories(spark, [("k", "Food", 1)]), source, "categories")
    with pytest.raises(PySparkException):
        pipelines.run_extract(spark, source, root, tables=["categories", "orders"])
    put(orders(spark, [("1", "Pending", 1)]), source, "orders")

    def gate(table, rows):
        pass

    loaded = pipelines.load_table(extract(spark, source, "categories"), root, "categories", T0)
    assert loaded.loaded == 1  # as if the run had died before it saved a mark
    pipelines.run_extract(spark, source, root, tables=["categories", "orders"], gate=gate)
    assert pipelines.read_staged(spark, root, "categories").count() == 2
    assert pipelines.read_latest(spark, root, "categories").count() == 1
    assert [r.status for r in log(spark, root)] == ["failed", "completed"]
    assert log(spark, root)[0].error_message


def test_a_gate_stops_the_load(spark, source, root):
    put(orders(spark, [("1", "Nowhere", 1)]), source, "orders")

    def gate(table, rows):
        quality.gate(quality.check_rows(rows, table, quality.row_rules(TABLES[table])))

    with pytest.raises(quality.QualityError, match="order_status_allowed"):
        run(spark, source, root, gate=gate)
    assert pipelines.read_staged(spark, root, "orders").count() == 0
    assert journal.read_marks(spark, root, "table_extract") == {}


def test_backdated_rows_are_missed_and_repaired(spark, source, root):
    put(orders(spark, [("1", "Pending", 9)]), source, "orders")
    run(spark, source, root)
    put(orders(spark, [("1", "Pending", 9), ("2", "Pending", 3), ("3", "Pending", 9)]), source,
        "orders")
    run(spark, source, root)
    assert set(statuses(spark, root)) == {"1"}
    assert pipelines.repair_late_rows(spark, source, root, "orders", hour(4)).loaded == 1
    assert set(statuses(spark, root)) == {"1", "3"}
    assert pipelines.repair_late_rows(spark, source, root, "orders", T0).loaded == 1
    assert set(statuses(spark, root)) == {"1", "2", "3"}
    assert pipelines.repair_late_rows(spark, source, root, "orders", T0).loaded == 0
    repairs = [r for r in log(spark, root) if r.pipeline_name == "table_extract_repair"]
    assert [(r.status, r.rows_loaded) for r in repairs] == [("completed", n) for n in (1, 1, 0)]


def test_a_repair_is_gated_and_finds_rows_without_a_stamp(spark, source, root):
    put(orders(spark, [("1", "Pending", 9)]), source, "orders")
    run(spark, source, root)
    unstamped = orders(spark, [("2", "Pending", 1)]).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    unstamped.write.mode("append").parquet(f"{source.root}/orders")

    def closed(table, rows):
        raise quality.QualityError(f"{table}: {rows.count()}")

    with pytest.raises(quality.QualityError, match="orders: 1"):
        pipelines.repair_late_rows(spark, source, root, "orders", T0, gate=closed)
    assert log(spark, root)[-1].status == "failed"
    assert pipelines.repair_late_rows(spark, source, root, "orders", T0).loaded == 1
    assert pipelines.repair_late_rows(spark, source, root, "orders", T0).loaded == 0
    assert set(statuses(spark, root)) == {"1", "2"}


def test_a_repair_reads_the_days_only_that_may_hold_a_row(spark, root):
    for day, stamp in ((1, 1), (2, 30), (3, 60)):
        done = pipelines.load_table(orders(spark, [(str(day), "Pending", stamp)]), root, "orders", datetime(2024, 5, day))
        pipelines._record(spark, root, "r", "orders", datetime(2024, 5, day), done)
    found = lambda a, b: {d.day for d in journal.load_days(spark, root, "orders", hour(a), hour(b))}
    assert found(20, 40) == {2} and found(0, 30) == {1, 2} and found(61, 90) == set()


def test_the_source_is_read_once_per_load(spark, root):
    """Rows that fit and rows that do not, counts, stamps and profile: one pass over the source."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = orders(spark, [("1", "Pending", 1), ("2" * 33, "Pending", 2), ("3", None, 3)])
    counted = rows.mapInArrow(count, rows.schema)
    done = pipelines.load_table(counted, root, "orders", T0)
    assert seen.value == 3
    assert (done.extracted, done.loaded, done.first, done.latest) == (3, 2, hour(1), hour(3))
    assert dict((c, n) for c, _, n in done.columns)["order_status"] == 2
    assert {r.order_id for r in pipelines.read_staged(spark, root, "orders").collect()} == {"1", "3"}
    (bad,) = pipelines.read_rejected(spark, root, "orders").collect()
    assert bad.order_id is None and bad["_rejected"] == ["order_id"] and bad["_given"] == {"order_id": "2" * 33}
    assert bad.order_status == "Pending"


def test_too_long_texts_and_phones_are_rejects(spark, root):
    person = ("u1", "c1", "A", "B", "a@x", "1" * 30, None, None, "j" * 150, T0, T0)
    fine = ("u2", "c1", "A", "B", "b@x", "1" * 20, None, None, "j" * 100, T0, T0)
    rows = spark.createDataFrame([person, fine], TABLES["customers"].source)
    assert pipelines.load_table(rows, root, "customers", T0).loaded == 1
    (bad,) = pipelines.read_rejected(spark, root, "customers").collect()
    assert bad["_rejected"] == ["phone_number", "job_title"] and bad["_given"]["phone_number"] == "1" * 30


def test_a_run_leaves_its_profile(spark, source, root):
    put(orders(spark, [("1", "Pending", 1), ("2", None, 2)]), source, "orders")
    run_id = run(spark, source, root)
    profiles = journal.read_profiles(spark, root).where(F.col("run_id") == run_id)
    got = {r.column_name: (r.position, r.data_type, r.non_null, r.missing) for r in profiles.collect()}
    assert got["order_status"] == (6, "string", 1, 1) and got["lead_id"][2:] == (0, 2)
    assert [(r.row_count, r.column_count) for r in journal.run_shapes(profiles).collect()] == [(2, 10)]
    (load,) = journal.read_loads(spark, root).collect()
    assert (load.rows_extracted, load.first_stamp, load.last_stamp) == (2, hour(1), hour(2))


def test_a_killed_run_is_closed_by_the_next(spark, source, root):
    put(orders(spark, [("1", "Pending", 1)]), source, "orders")
    killed = journal.start_run(spark, root, "table_extract", hour(1))  # and no end
    other = journal.start_run(spark, root, "web_logs_snapshot", hour(1))
    assert {r.run_id for r in journal.open_runs(spark, root).collect()} == {killed, other}
    run(spark, source, root)
    runs = {r.run_id: r for r in log(spark, root)}
    assert (runs[killed].status, runs[killed].error_message) == ("failed", journal.INTERRUPTED)
    assert {r.run_id for r in journal.open_runs(spark, root).collect()} == {other}
    metrics = {m.pipeline_name: m for m in journal.run_metrics(
        journal.run_log(journal.read_events(spark, root))).collect()}
    assert (metrics["table_extract"].runs, metrics["table_extract"].failed_runs) == (2, 1)


def test_an_append_that_dies_is_repeated_once(spark, root, monkeypatch):
    path, schema = f"{root}/daily", TABLES["categories"].source
    csv_files.append_csv(categories(spark, [("k1", "Food", 1)]), path, "monday")
    second = categories(spark, [("k2", "Medical", 1), ("k3", "Toys", 1)])
    # Files are written, the marker is not: nothing of the run is read.
    csv_files.write_csv(second, f"{path}/_run=tuesday")
    ids = lambda: sorted(r.category_id for r in csv_files.read_appended(spark, path, schema).collect())
    assert ids() == ["k1"]
    for _ in range(2):
        csv_files.append_csv(second, path, "tuesday")
        assert ids() == ["k1", "k2", "k3"]
    csv_files.append_csv(categories(spark, [("k4", "Garden", 1)]), path, "1e5")
    assert ids() == ["k1", "k2", "k3", "k4"]
    assert csv_files.read_appended(spark, f"{root}/none", schema).count() == 0


def test_database_ranges_hold_each_row_once(spark):
    for low, high, parts in ((0, 100, 4), (5, 7, 8), (T0, hour(1000), 5), (3, 3, 4), (None, None, 4),
                             (T0.date(), hour(24 * 9).date(), 4), (0.0, 1.0, 3)):
        ranges = range_predicates("c", low, high, parts)
        assert 1 <= len(ranges) <= parts
        if low is None:
            assert ranges == ["1 = 1"]
            continue
        between = [low + (high - low) * i / 10 if not isinstance(low, (int, type(T0.date()))) else low
                   for i in range(11)]
        values = [*between, low, high, None]
        kind = {int: "INT", float: "DOUBLE", datetime: "TIMESTAMP_NTZ"}.get(type(low), "DATE")
        rows = spark.createDataFrame([(v,) for v in values], f"c {kind}")
        assert sum(rows.where(r).count() for r in ranges) == len(values)
    assert range_predicates("c", 0, 100, 4) == [
        "c < 25 OR c IS NULL", "c >= 25 AND c < 50", "c >= 50 AND c < 75", "c >= 75"]
    assert bounds_query("source.Orders", "updated_at") == (
        "SELECT min(updated_at) AS low, max(updated_at) AS high FROM source.Orders")
    options = Source(format="jdbc", options={"url": "u"}, per_table={"orders": {"fetchsize": "9"}})
    assert options.database_options("orders") == {"preferTimestampNTZ": "true", "url": "u", "fetchsize": "9"}


def test_rows_that_do_not_fit_are_kept_aside(spark, source, root):
    item = ("i", "o", "m", 1, Decimal("100000000.00"), Decimal("0.00"), Decimal("1.00"), T0, T0)
    fine = ("j", "o", "m", 1, Decimal("1.00"), Decimal("0.00"), Decimal("1.00"), T0, T0)
    put(spark.createDataFrame([item, fine], TABLES["order_items"].source), source, "order_items")
    pipelines.run_extract(spark, source, root, tables=["order_items"])
    (entry,) = log(spark, root)
    assert (entry.rows_extracted, entry.rows_loaded) == (2, 1)
    (bad,) = spark.read.parquet(pipelines.rejects_path(root, "order_items")).collect()
    assert bad.order_item_id == "i" and bad["_rejected"] == ["unit_price"]


def test_all_extracted_tables_of_a_source(spark, source, root):
    frames = {"orders": orders(spark, [("1", "Pending", 1)]),
              "categories": categories(spark, [("k", "Food", 1)])}
    assert append_to_source(frames, source) == ["categories", "orders"]
    assert append_to_source({"orders": orders(spark, [("2", "Pending", 1)])}, source) == ["orders"]
    assert extract(spark, source, "orders").count() == 2


LEADS = TABLES["marketing_leads"]
HEADER = ",".join(LEADS.columns)
GOOD = ('1,Website,Free Trial,google,cpc,free_trial,"Ode, ""The"" Firm",1-10,Retail,US,NY,7,'
        "1500.25,New,2024-01-01 10:00:00,2024-01-02 11:30:00.000123")


def csv(root, name, *lines):
    path = f"{root}/{name}.csv"
    with open(path, "w") as file:
        file.write("\n".join(lines) + "\n")
    return path


def test_a_snapshot_replaces_the_one_before(spark, root):
    first = csv(root, "first", HEADER, GOOD, GOOD.replace("1,", "2,", 1))
    pipelines.run_snapshot(spark, first, root, "marketing_leads")
    second = csv(root, "second", HEADER, GOOD)
    pipelines.run_snapshot(spark, second, root, "marketing_leads")
    (row,) = pipelines.read_snapshot(spark, root, "marketing_leads").collect()
    assert row.company_name == 'Ode, "The" Firm'
    assert row.updated_at == datetime(2024, 1, 2, 11, 30, 0, 123)
    assert row.estimated_order_value == Decimal("1500.25") and row.lead_score == 7


def test_an_empty_snapshot_leaves_the_old_rows(spark, root):
    pipelines.run_snapshot(spark, csv(root, "a", HEADER, GOOD), root, "marketing_leads")
    with pytest.raises(csv_files.EmptySourceError):
        pipelines.run_snapshot(spark, csv(root, "b", HEADER), root, "marketing_leads")
    assert pipelines.read_snapshot(spark, root, "marketing_leads").count() == 1
    assert [(r.status, r.rows_extracted) for r in log(spark, root)] == [
        ("completed", 1), ("failed", 0)]


def test_a_failed_reload_leaves_the_old_rows(spark, root, monkeypatch):
    pipelines.run_snapshot(spark, csv(root, "a", HEADER, GOOD), root, "marketing_leads")

    def broken(*_):
        raise OSError("disk gone")

    monkeypatch.setattr(versions, "switch_to", broken)
    with pytest.raises(OSError):
        pipelines.run_snapshot(spark, csv(root, "b", HEADER, GOOD, GOOD), root, "marketing_leads")
    monkeypatch.undo()
    assert pipelines.read_snapshot(spark, root, "marketing_leads").count() == 1
    failed = log(spark, root)[1]
    assert (failed.status, failed.rows_extracted, failed.error_message) == ("failed", 2, "disk gone")


def test_bad_lines_are_kept_aside(spark, root):
    bad = GOOD.replace(",7,", ",many,")
    pipelines.run_snapshot(spark, csv(root, "a", HEADER, GOOD, bad), root, "marketing_leads")
    assert pipelines.read_snapshot(spark, root, "marketing_leads").count() == 1
    (line,) = pipelines.read_rejected_lines(spark, root, "marketing_leads").collect()
    assert ",many," in line["_corrupt_record"]
    (entry,) = log(spark, root)
    assert (entry.rows_extracted, entry.rows_loaded) == (2, 1)


def test_a_header_that_disagrees_is_an_error(spark, root):
    path = csv(root, "a", HEADER.replace("lead_score", "score"), GOOD)
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        pipelines.run_snapshot(spark, path, root, "marketing_leads")
    assert [r.status for r in log(spark, root)] == ["failed"]


def test_line_breaks_in_fields(spark, root):
    path = csv(root, "a", HEADER, GOOD.replace("Firm", "Fi\nrm"))
    lines = csv_files.read_csv(spark, path, LEADS.source, multi_line=True)
    assert csv_files.good_lines(lines).first().company_name == 'Ode, "The" Fi\nrm'


def test_a_line_is_judged_whole_whatever_is_selected(spark, root):
    header = ",".join(TABLES["web_logs"].columns)
    line = "{},US,NY,2024-01-01 10:00:00,1.1.1.1,,s,GET,/,200,10,r,Mobile,Edge,{}"
    path = csv(root, "a", header, line.format(1, "True"), line.format(2, "perhaps"))
    rows = csv_files.read_csv(spark, path, TABLES["web_logs"].source)
    good = csv_files.good_lines(rows)
    assert [r.log_id for r in good.select("log_id").collect()] == ["1"]
    assert good.count() == len(good.collect()) == csv_files.bad_lines(rows).count() == 1


def test_marks_of_loaded_tables_survive_a_later_failure(spark, source, root, monkeypatch):
    put(categories(spark, [("k1", "Food", 2)]), source, "categories")
    put(orders(spark, [("1", "Pending", 1)]), source, "orders")
    whole = pipelines.load_table

    def broken(rows, root, table, at):
        if table == "orders":
            raise OSError("disk gone")
        return whole(rows, root, table, at)

    monkeypatch.setattr(pipelines, "load_table", broken)
    with pytest.raises(OSError):
        pipelines.run_extract(spark, source, root, tables=["categories", "orders"])
    monkeypatch.undo()
    assert journal.read_marks(spark, root, "table_extract") == {"categories": hour(2)}
    pipelines.run_extract(spark, source, root, tables=["categories", "orders"])
    assert pipelines.read_staged(spark, root, "categories").count() == 1
    assert statuses(spark, root) == {"1": "Pending"}


def test_rows_stamped_after_the_start_wait_for_the_next_run(spark, source, root):
    put(orders(spark, [("1", "Pending", 1), ("2", "Pending", 5)]), source, "orders")
    run(spark, source, root, clock=lambda: hour(3))
    assert statuses(spark, root) == {"1": "Pending"}
    run(spark, source, root, clock=lambda: hour(6))
    assert statuses(spark, root) == {"1": "Pending", "2": "Pending"}


def test_booleans_and_missing_fields_of_logs(spark, root):
    header = ",".join(TABLES["web_logs"].columns)
    path = csv(root, "a", header, "1,US,NY,2024-01-01 10:00:00,1.1.1.1,,s,GET,/,200,10,r,Mobile,"
               "Edge,True", "2,US,NY,2024-01-01 10:00:00,1.1.1.1,bo,s,GET,/,200,10,r,Mobile,Edge,False")
    rows = csv_files.good_lines(csv_files.read_csv(spark, path, TABLES["web_logs"].source))
    got = {r.log_id: (r.is_bot, r.auth_user) for r in rows.collect()}
    assert got == {"1": (True, None), "2": (False, "bo")}


def test_steps_go_on_after_a_failure():
    def broken():
        raise RuntimeError("no such row")

    done = pipelines.run_steps({"companies": lambda: 3, "customers": broken, "orders": lambda: 0})
    assert {n: s.rows for n, s in done.items()} == {"companies": 3, "customers": 0, "orders": 0}
    assert done["customers"].error == "no such row"


def test_run_log_and_metrics(spark):
    events = spark.createDataFrame([
        ("r1", "p", "started", hour(0), None, None, None, "running", None),
        ("r1", "p", "ended", hour(1), 10, 8, hour(0), "completed", None),
        ("r2", "p", "started", hour(2), None, None, None, "running", None),
        ("r2", "p", "ended", hour(5), 2, 0, None, "failed", "lost"),
        ("r3", "p", "started", hour(6), None, None, None, "running", None),
    ], RUN_EVENTS)
    runs = journal.run_log(events)
    assert {r.run_id: (r.status, r.rows_loaded, r.error_message) for r in runs.collect()} == {
        "r1": ("completed", 8, None), "r2": ("failed", 0, "lost"), "r3": ("running", None, None)}
    (m,) = journal.run_metrics(runs).collect()
    assert (m.runs, m.failed_runs, m.rows_extracted, m.rows_loaded) == (3, 1, 12, 8)
    assert m.mean_seconds == 7200.0 and abs(m.failure_rate - 1 / 3) < 1e-12


def test_marks_move_only_forward_with_new_rows(spark, root):
    assert journal.later_mark(None, None) is None
    assert journal.later_mark(hour(2), None) == hour(2)
    assert journal.later_mark(hour(2), hour(1)) == hour(2)
    assert journal.save_marks(spark, root, "p", "r", T0, {"a": T0}, {"a": T0, "b": None}) == {}
    assert journal.read_marks(spark, root, "p") == {}
    journal.save_marks(spark, root, "p", "r1", hour(1), {}, {"a": hour(1), "b": hour(2)})
    journal.save_marks(spark, root, "p", "r2", hour(3), {"a": hour(1)}, {"a": hour(9)})
    journal.save_marks(spark, root, "q", "r2", hour(3), {}, {"a": hour(4)})
    assert journal.read_marks(spark, root, "p") == {"a": hour(9), "b": hour(2)}


def test_arrivals_take_each_file_once(spark, root):
    rows = spark.createDataFrame([(str(i), i % 3 == 0) for i in range(30)], "log_id STRING, b BOOLEAN")
    layout = TABLES["web_logs"].source
    full = rows.select(*[
        (F.col("log_id") if f.name == "log_id" else F.col("b") if f.name == "is_bot"
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in layout])
    for part in (F.col("is_bot"), ~F.col("is_bot")):
        csv_files.write_csv(full.where(part), f"{root}/landing", append=True)
        arrivals.take_in(spark, f"{root}/landing", root, "web_logs", files_per_batch=2)
    arrivals.take_in(spark, f"{root}/landing", root, "web_logs")
    got = arrivals.read_arrivals(spark, root, "web_logs")
    assert sorted(int(r.log_id) for r in got.collect()) == list(range(30))
    assert arrivals.read_rejected_arrivals(spark, root, "web_logs").count() == 0

    blanks = "," * (len(layout) - 2)
    csv(f"{root}/landing", "bad", ",".join(layout.fieldNames()), f"30{blanks},true",
        f"31{blanks},perhaps")
    arrivals.take_in(spark, f"{root}/landing", root, "web_logs")
    assert arrivals.read_arrivals(spark, root, "web_logs").count() == 31
    (line,) = arrivals.read_rejected_arrivals(spark, root, "web_logs").collect()
    assert line["_corrupt_record"].startswith("31")

    # A snapshot's bad lines of the same table stand apart.
    path = csv(root, "c", ",".join(layout.fieldNames()), f"32{blanks},true", f"33{blanks},perhaps")
    pipelines.run_snapshot(spark, path, root, "web_logs")
    assert arrivals.read_rejected_arrivals(spark, root, "web_logs").count() == 1
    assert pipelines.read_rejected_lines(spark, root, "web_logs").count() == 1
