from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotline.functions import numbers, status, text, times
from depotline.schemas import FUNNEL_STAGES, STAGE_SCORES


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_text(spark):
    cases = [
        (text.without_dashes(F.lit("6f1-a-2")), "6f1a2"),
        (text.user_name(F.lit("Mary Ann"), F.lit("O-Hara")), "maryann.ohara"),
        (text.user_name(F.lit("Bo"), F.lit("Li"), "+updated"), "bo.li+updated"),
        (text.email_address(F.lit("bo.li"), F.lit(17), F.lit("mail.com")), "bo.li17@mail.com"),
        (text.phone_digits(F.lit("+1 (555) 010-2030 x44")), "155501020304"),
        (text.phone_digits(F.lit("+1 (555) 010-2030 x44"), None), "1555010203044"),
        (text.is_short_phone(F.lit("555-0102")), True),
        (text.slug(F.lit("Summer Sale")), "summer_sale"),
        (text.first_word(F.lit("  Smith-Jones and Sons")), "smithjones"),
        (text.full_name(F.lit("Bo"), F.lit("Li")), "Bo Li"),
        (text.with_suffix(F.lit("Acme"), "Group"), "Acme Group"),
        (text.upper_code(F.lit("ab-12")), "AB-12"),
        (text.user_name(F.lit(None).cast("string"), F.lit("x")), None),
    ]
    for column, expected in cases:
        assert value(spark, column) == expected


def test_line_total_is_exact(spark):
    amount = numbers.line_total(F.lit(3), F.lit("2.35").cast("decimal(12,2)"),
                                F.lit("0.05").cast("decimal(12,2)"))
    assert value(spark, amount) == Decimal("7.00")


@pytest.mark.parametrize("given, expected", [(0.2, 1.0), (3.3, 3.3), (9.0, 5.0)])
def test_clamp(spark, given, expected):
    assert value(spark, numbers.clamp(F.lit(given), 1.0, 5.0)) == expected


def test_ratio_of_nothing_is_null(spark):
    assert value(spark, numbers.ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize("given, cancel, expected", [
    ("Processing", None, "Confirmed"), ("Processing", True, "Cancelled"),
    ("Processing", False, "Confirmed"), ("Confirmed", True, "Shipped"),
    ("Shipped", None, "Delivered"), ("Delivered", None, "Delivered"),
    ("Pending", None, "Pending"), ("Cancelled", None, "Cancelled"),
])
def test_next_status(spark, given, cancel, expected):
    choice = None if cancel is None else F.lit(cancel)
    assert value(spark, status.next_status(F.lit(given), choice)) == expected


@pytest.mark.parametrize("given, expected", [
    ("Shipped", "paid"), ("Delivered", "paid"), ("Cancelled", "pending"), ("Pending", "pending"),
])
def test_expected_payment(spark, given, expected):
    assert value(spark, status.expected_payment(F.lit(given))) == expected


def test_stages_after(spark):
    assert value(spark, status.stages_after(F.lit("Negotiation"))) == ["Won", "Lost"]
    assert value(spark, status.stages_after(F.lit("Lost"))) == []
    assert value(spark, status.stages_after(F.lit("Unheard"))) is None
    assert value(spark, status.others(["a", "b", "c"], F.lit("b"))) == ["a", "c"]


def test_stage_ranges(spark):
    for stage in FUNNEL_STAGES:
        low, high = STAGE_SCORES[stage]
        fits = [value(spark, status.in_range_of(F.lit(n), F.lit(stage), STAGE_SCORES))
                for n in (low - 1, low, high, high + 1)]
        assert fits == [False, True, True, False]
    assert value(spark, status.in_range_of(F.lit(5), F.lit("Unheard"), STAGE_SCORES)) is None


def test_advance(spark):
    leads = spark.createDataFrame(
        [(1, "New", 3, "Won"), (2, "Won", 90, "New"), (3, "Lost", 7, None)],
        "id INT, stage STRING, score INT, target STRING")
    moved = status.advance(leads, "stage", "score", F.col("target"),
                           lambda s: status.range_low(s, STAGE_SCORES))
    rows = {r.id: (r.new_stage, r.new_score) for r in moved.collect()}
    assert rows == {1: ("Won", 81), 2: ("Won", 90), 3: ("Lost", 7)}


def test_times(spark):
    moment = datetime(2024, 3, 31, 2, 30, 0, 5)
    assert value(spark, times.at(moment)) == moment
    assert value(spark, times.parse_timestamp(F.lit("2024-03-31 02:30:00.000005"))) == moment
    assert value(spark, times.parse_timestamp(F.lit("soon"))) is None
    assert value(spark, times.month_of(times.at(moment))) == "2024-03"
    assert value(spark, times.day_of(times.at(moment))) == "2024-03-31"
    assert value(spark, times.later_of(times.at(moment), times.at(datetime(2025, 1, 1)))).year == 2025


def test_dates_do_not_depend_on_the_session_zone(spark):
    moment = times.at(datetime(2024, 3, 31, 2, 30))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert value(spark, times.month_of(moment)) == "2024-03"
        assert value(spark, times.day_of(moment)) == "2024-03-31"
        assert value(spark, times.parse_timestamp(F.lit("2024-03-31 02:30:00"))) == datetime(
            2024, 3, 31, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
