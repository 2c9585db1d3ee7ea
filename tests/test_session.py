"""Settings of a session."""

from depotline.session import PART, PART_BYTES, tune


def test_parts_stay_small_unless_the_session_says_otherwise(spark):
    fresh = spark.newSession()
    assert tune(fresh).conf.get(PART) == PART_BYTES
    fresh.conf.set(PART, "8m")
    assert tune(fresh).conf.get(PART) == "8m"
