"""Every operator on hostile tables: nulls, empty and very long texts, repeated rows, clashing names."""

import pytest

from depotline.llm import (
    common,
    language_model,
    merkle,
    packing,
    paragraphs,
    ranking,
    rules,
    spelling,
    toxicity,
    wrappers,
)

LONG = "word " * 40_000
ROWS = [(1, "plain words of a text that goes on and on, with more of them"), (2, None), (3, ""), (4, " \n\t "),
        (5, LONG), (6, "x" * 200_000), (None, "no id"), (None, None),
        (1, "plain words of a text that goes on and on, with more of them")]


@pytest.fixture
def docs(spark):
    """The rows with columns named like what the operators add."""
    rows = [(*r, "s", "clash", 0.5, True, 7) for r in ROWS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, score double, kept boolean, n_words int")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(100, 180)], "doc_id long, quality int, toxic int")


@pytest.fixture
def taught(spark, docs):
    """The hostile rows among others that labels speak of."""
    more = [(i, " ".join(f"{'grobbix' if i % 2 and k % 9 == 0 else 'term' + 'abcdefghij'[k * i % 10] * 2}" for k in range(60)),
             "s", "l", 0.0, False, 1) for i in range(100, 180)]
    return docs.unionByName(spark.createDataFrame(more, docs.schema))


def test_classifiers(taught, labels):
    for scored in (ranking.scored, toxicity.scored):
        found = scored(taught, labels)
        assert sorted(found.columns) == sorted(taught.columns)
        rows = found.collect()
        assert len(rows) == len(ROWS) + 80 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
        lowest = min(r.score for r in rows)
        assert all(r.score == lowest for r in rows if r.doc_id in (2, 3, 4))
        assert scored(taught.limit(0), labels).count() == 0
    kept = toxicity.accepted(taught, labels)
    assert kept.columns == taught.columns and kept.where("doc_id IN (2, 3, 4)").count() == 3


def test_rule_cascade(docs):
    found = rules.screened(docs, with_counts=True)
    got = sorted((str(r.doc_id), r.n_words, r.kept) for r in found.collect())
    assert [g for g in got if g[0] in "234"] == [("2", 0, False), ("3", 0, False), ("4", 0, False)]
    assert sum(g[0] == "1" for g in got) == 2 and ("5", 40_000, False) in got
    assert rules.screened(docs.limit(0)).count() == 0


def test_paragraphs(docs):
    found = {(r.doc_id, r.removed) for r in paragraphs.repeats(docs).collect()}
    assert (2, True) not in found and (3, True) not in found and any(i == 5 for i, _ in found)
    cut = paragraphs.without_repeats(docs)
    assert cut.count() == len(ROWS)


def test_language_model(docs):
    base = docs.select("doc_id", "text")
    rows = language_model.scored(base).collect()
    assert len(rows) == len(ROWS)
    assert all(r.score < 0 and r.base_score <= 0 for r in rows)
    tokens = sorted(r.n_tokens for r in rows)
    assert tokens[-1] == 40_001 and tokens.count(1) == 4
    assert language_model.scored(base.limit(0)).count() == 0


def test_wrappers(spark):
    deep = "<div>" * 3_000 + "deep" + "</div>" * 3_000
    long = "<article>" + "<p>para graph</p>" * 20_000 + "</article>"
    rows = [(1, "http://a/1", deep), (1, "http://a/1", deep), (2, "http://a/2", long), (3, None, "<p>x</p>"),
            (None, "http://b/1", None), (5, "no url", "<<<>&#0;&#xFFFFFF;&bogus;<p"), (6, "http://a/3", "")]
    frame = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    found = wrappers.extracted(frame)
    got = found.collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    assert next(r for r in got if r.page_id == 2).text == " ".join(["para graph"] * 20_000)
    assert wrappers.extracted(frame.limit(0)).count() == 0


def test_new_operators(docs):
    assert sum(r.length for r in packing.packed(packing.pieces(docs)).collect()) > 40_000
    leaves = docs.withColumn("leaf", merkle.leaf(common.plain("text"))).withColumn("root", common.plain("lang"))
    assert merkle.manifest(leaves, "source", "doc_id", "leaf").count() == len(ROWS)
    assert {(r.word, r.n) for r in spelling.variants(docs).collect()} == {("x" * 200_000, 1)} - {("x" * 200_000, 1)}
