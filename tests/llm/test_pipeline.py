"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

import random
import re

import pytest

import corpus_pipeline
from depotline.llm import mixing

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _classes(rows):
    """Least doc_id of each document's class of near copies."""
    sets, top = [_grams(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "") or (
                sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
            if same:
                a, b = sorted((find(i), find(j)))
                top[b] = a
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return {min(g) for g in groups.values()}


def _clean(text, items):
    words, hit = _words(text), set()
    for item in items:
        w = _words(item)
        n = min(13, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in windows:
                hit |= set(range(i, i + n))
    return not (hit and 20 * len(hit) >= len(words))


@pytest.fixture
def corpus(spark, root):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ran", "sol", "ven") for c in ("to", "pe", "ri")]
    items = [" ".join(rng.choice(vocabulary) for _ in range(20)) for _ in range(3)] + ["short one", None, ""]
    docs, labels = [], []
    for i in range(260):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 90))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["grobbix", "snurfled"])
        if i % 20 == 7:
            words[3:3] = items[i % 3].split()
        docs.append((i, " ".join(words), "en", f"s{i % 3}" if i % 9 else None, None))
        labels.append((i, 1, int(toxic)))
    for i in range(40):  # copies and near copies of clean documents
        text = docs[11 + i % 4][1].split()
        if i % 2:
            text[5] = f"other{i}"
        docs.append((300 + i, " ".join(text), None, "s1", 3))
    docs += [(400, None, None, None, None), (401, "", None, "s2", 0), (401, "", None, "s2", 0)]
    for name, rows, kind in (("documents", docs, COLUMNS), ("labels", labels, "doc_id long, quality int, toxic int"),
                             ("benchmark", list(enumerate(items)), "item_id long, text string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{root}/{name}.parquet")
    return root, docs, dict((d, t) for d, _, t in labels), items


def test_stages_equal_brute_force(spark, corpus):
    root, rows, toxic, items = corpus
    docs, seen = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{root}/out-{name}"
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]

    kept = {r.doc_id for r in seen["toxicity"]}
    assert all((i in kept) == (not bad) for i, bad in toxic.items()) and {400, 401, 300} <= kept
    left = [tuple(r) for r in seen["toxicity"]]
    assert {r.doc_id for r in seen["near_duplicates"]} == _classes(left)
    assert len(seen["near_duplicates"]) == len(_classes(left))
    clean = {r.doc_id for r in seen["near_duplicates"] if _clean(r.text, items)}
    assert {r.doc_id for r in seen["decontamination"]} == clean
    assert 0 < len(clean) < len(seen["near_duplicates"])

    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in seen["decontamination"]}
    counts, taken = {}, {}
    for r in seen["mixing"]:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id]
    assert set(counts) <= clean and max(counts.values()) <= mixing.MOST
    sources = {r.doc_id: r.source for r in seen["decontamination"]}
    names = sorted({s for s in sources.values() if s is not None}) + [None]
    own = {s: sum(n for d, n in size.items() if sources[d] == s) for s in names}
    level = sum(own.values()) / sum(i % 3 + 1 for i in range(len(names)))
    for i, s in enumerate(names):
        want = level * (i % 3 + 1)
        assert want < 3 * own[s] and abs(taken[s] - want) <= 45

    assert len(seen["sharding"]) == len(seen["mixing"])
    shards = {}
    for r in seen["sharding"]:
        shards.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    again = corpus_pipeline.run(spark, root).collect()
    assert sorted(map(str, again)) == sorted(map(str, seen["sharding"]))


def test_empty_tables(spark, root):
    for name, kind in (("documents", COLUMNS), ("labels", "doc_id long, quality int, toxic int"),
                       ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{root}/{name}.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0
