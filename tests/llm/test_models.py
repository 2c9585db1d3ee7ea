"""Classifiers, rules, wrappers and the language model."""

import math
import random
import zlib

from depotline.llm import attention, language_model, ranking, rules, toxicity, wrappers

FOLDER = "/root/testdata/sf0.01"


def _labelled(spark):
    return (spark.read.parquet(f"{FOLDER}/documents.parquet"),
            spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_quality_on_held_out_documents(spark):
    docs, labels = _labelled(spark)
    rows = ranking.scored(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in held) > 0.95 * len(held)


def test_toxicity_on_a_made_corpus(spark):
    rng = random.Random(1)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ter") for b in ("ran", "sol", "ven", "dil", "pas")]
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        if bad := i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["grobbix", "snurf"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs += [(1000, None), (1001, ""), (1002, "ran grob.bix sol"), (1003, "g r o b b i x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.scored(frame, known).collect()}
    truth = dict(labels)
    assert all((score[i] >= 0.7) == bool(truth[i]) for i in truth)
    assert score[1000] < 0.1 and score[1001] < 0.1 and score[1002] > 0.7 and score[1003] > 0.7
    assert {r.score for r in toxicity.scored(frame, known.limit(0)).collect()} == {0.0}


def test_rules_do_not_depend_on_their_order(spark):
    frame = spark.createDataFrame(
        [(1, None, True), (2, "", True), (3, " ".join(f"word{i}" for i in range(60)), False),
         (4, "a b c " * 40, True)], "doc_id long, text string, kept boolean")
    kept = rules.accepted(frame)
    assert kept.columns == frame.columns and [tuple(r)[0] for r in kept.collect()] == [3]
    assert rules.counts("a b c a b c\nx\nx") == (8, 8, 0, 1, 6)
    texts = ["a b c " * 40, "#" * 60, " ".join(f"w{i}" for i in range(60))]
    orders = [rules.RULES, rules.RULES[::-1], [m.rule for m in rules.ordered(rules.RULES, texts)]]
    assert len({tuple(rules.first_failed(t, o) is None for t in texts) for o in orders}) == 1


def test_wrapper_extraction(spark):
    page = ('<html><header>H</header><div class="ad">A</div><article><h1>T&eacute;</h1><p>{} <b>b</b>old'
            '<br>x<div class="comments">C</div></article><footer>F</footer></html>')
    rows = [(1, "http://h/1", page.format("one")), (2, "http://h/2", page.format("two  three")),
            (3, None, None), (4, "http://h/3", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extracted(frame).collect()}
    assert got == {1: "Té one bold x", 2: "Té two three bold x", 3: "", 4: ""}
    both = wrappers.merged(wrappers.wrapper_of("<ul><li>a<li>b</ul>"), wrappers.wrapper_of("<p>x</p><ul><li>c</ul>"))
    assert wrappers.expression(both).replace("  ", " ") == "<html> (<p> 'x' </>)? <ul> (<li> #text </>)+ </> </>"


def test_language_model_base_counts(spark):
    rows = [(i, t) for i, t in enumerate(["The cat the dog", "a cat", None, "", "new words here", "the end"] * 4)]
    got = language_model.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    counts = {}
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in [*(t or "").lower().split(), ""]:
                counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    for r in got:
        words = [*(rows[r.doc_id][1] or "").lower().split(), ""]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (
            len(words), sum(w in counts for w in words), total)
        assert abs(r.base_score - base) < 1e-6 and r.score < 0


def test_windows_score_each_token_once():
    import numpy as np

    params = attention.fresh_params()
    long = np.arange(50) % 100
    inputs, targets, first, starts = attention.blocks([long, long[:3]])
    odds = attention.log_odds(params, inputs, targets, first)
    assert (targets >= 0).sum() == 51 + 4 and (odds[targets < 0] == 0).all()
    # A text's odds do not depend on its neighbours.
    alone = attention.log_odds(params, *attention.blocks([long[:3]])[:3])
    assert np.allclose(odds[starts[1]:], alone, atol=1e-5)
