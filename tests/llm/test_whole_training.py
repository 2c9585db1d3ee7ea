"""Quality and toxicity are learnt from every labelled document, however long."""

import zlib

import numpy as np

from depotline.llm import ranking, toxicity
from depotline.llm.training import labelled


def _docs(spark, bad, words):
    """Rows whose odd ones hold `bad`; every one has more characters than the old samples took."""
    rows = [(i, " ".join([f"term{'abcdefghij'[(k * i + k) % 10] * 2}" for k in range(words)]
                         + ([bad] * 40 if i % 2 else []))) for i in range(60)]
    labels = [(i, 1 - i % 2, i % 2) for i in range(60)]
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_long_labelled_texts_are_learnt_from(spark):
    docs, labels = _docs(spark, "#|#", 4_000)
    found = {r.doc_id: r.score for r in ranking.scored(docs, labels).collect()}
    assert all((found[i] >= 0.5) == (i % 2 == 0) for i in found)
    docs, labels = _docs(spark, "grobbix", 900)
    found = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    assert all((found[i] >= toxicity.THRESHOLD) == (i % 2 == 1) for i in found)


def test_every_labelled_document_is_learnt_from(spark):
    docs, labels = _docs(spark, "x", 10)
    more = spark.createDataFrame([(1, 0, 0), (2, None, None), (None, 1, 1)], labels.schema)
    texts = labelled(docs.union(docs.limit(5)), labels.union(more), "toxic")
    learnt = {r.doc_id: r.text for r in docs.collect()}
    wanted = {(t, i % 2) for i, t in learnt.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    assert {(r.text, r.y) for r in texts.collect()} == wanted
    figures = ranking.described(texts, lambda some: np.array([ranking.features(t) for t in some]),
                                ranking.FEATURES, "features")
    assert figures.count() == len(wanted)
    pairs = ranking._blocks(figures, {1: sum(y for _, y in wanted), 0: sum(1 - y for _, y in wanted)})
    sizes = [(len(r.good) // ranking.FEATURES, len(r.bad) // ranking.FEATURES) for r in pairs.collect()]
    assert sum(g for g, _ in sizes) == sum(y for _, y in wanted)
    assert sum(b for _, b in sizes) == sum(1 - y for _, y in wanted)


def test_rare_labels_are_in_every_block(spark):
    rows = spark.range(1_000).selectExpr("id", "IF(id < 5, 0, 1) y", *(f"double(id) x{i}" for i in range(ranking.FEATURES)))
    sizes = [(len(r.good), len(r.bad)) for r in ranking._blocks(rows, {1: 995, 0: 5}).collect()]
    assert len(sizes) == 8 and all(g and b for g, b in sizes)
    assert sum(g for g, _ in sizes) == 995 * ranking.FEATURES


def test_quantile_is_exact(spark):
    s = np.round(np.random.default_rng(1).standard_normal(5_000) ** 3, 6)
    frame = spark.createDataFrame([(float(v), int(i % 4 > 0)) for i, v in enumerate(s)], "s double, y int")
    cut = ranking._quantile(frame, {0: 1 / 5_000, 1: 1 / 5_000}, 0.3)
    assert (s < cut).sum() == 1_500
    same = spark.createDataFrame([(2.0, 1), (2.0, 0)], "s double, y int")
    assert ranking._quantile(same, {0: 0.5, 1: 0.5}, 0.5) == 2.0
