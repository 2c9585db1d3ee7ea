"""The bounded sample of labelled documents."""

import pytest

from depotline.llm.training import labelled_sample


def _frames(spark, n, long):
    rows = [(i, ("long " * 50 if long(i) else "short ") + str(i)) for i in range(n)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int"))


def test_long_texts_do_not_shrink_the_sample(spark):
    docs, labels = _frames(spark, 2_000, lambda i: i % 10 > 1)
    found = labelled_sample(docs, labels, "toxic", 100, 40)
    assert all(70 <= sum(y == k for _, y in found) <= 150 for k in (0, 1))


def test_a_kind_without_a_fitting_text_is_an_error(spark):
    docs, labels = _frames(spark, 100, lambda i: i % 2 == 1)
    with pytest.raises(ValueError, match="both kinds"):
        labelled_sample(docs, labels, "toxic", 100, 40)
