"""Merkle manifests against trees built in one place."""

from hashlib import sha256

from pyspark.sql import functions as F

from depotline.llm import merkle


def _h(text):
    return sha256(text.encode()).hexdigest()


def _paths(nodes):
    """The root, and every node's siblings upwards."""
    paths, at = ["" for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place - place % 16
            paths[i] += "".join(nodes[run:place] + nodes[place + 1:run + 16])
        nodes = [_h("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], paths


def _manifest(rows):
    trees = {}
    for tree, order, leaf in rows:
        trees.setdefault(tree, []).append((order is not None, order or 0, leaf))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {t: _paths([r[2] for r in sorted(trees[t])]) for t in names}
    root, tops = _paths([built[t][0] for t in names])
    return sorted((str(t), str(o) if known else "None", leaf, built[t][0], root, _h(path + top))
                  for t, top in zip(names, tops, strict=True)
                  for (known, o, leaf), path in zip(sorted(trees[t]), built[t][1], strict=True))


def _got(spark, rows, levels, parts=3):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "source string, doc_id long, leaf string, part string")
    found = merkle.manifest(frame.repartition(parts), "source", "doc_id", "leaf", ("part",), levels)
    assert found.columns == ["source", "leaf", "doc_id", "part", "subroot", "root", "proof"]
    right = merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")
    wrong = merkle.folded(F.sha2(F.col("leaf"), 256), F.col("proof")) == F.col("root")
    out = found.select("source", "doc_id", "leaf", "subroot", "root",
                       merkle.hashed(merkle.siblings(F.col("proof"))).alias("p"), right.alias("r"),
                       wrong.alias("w"), "part").collect()
    assert all(r.r and not r.w and r.part == "x" for r in out)
    return sorted((str(r.source), str(r.doc_id), r.leaf, r.subroot, r.root, r.p) for r in out)


def test_trees_of_many_sizes(spark):
    sizes = {None: 1, "a": 1, "b": 16, "c": 17, "d": 273, "é": 4_400, "z": 33, "": 2}
    rows = [(t, i, _h(f"{t}{i}")) for t, n in sizes.items() for i in range(n)]
    want = _manifest(rows)
    assert _got(spark, rows, levels=1) == want
    assert _got(spark, rows, levels=3, parts=7) == want


def test_null_ids_repeated_rows_and_one_row(spark):
    rows = [("a", None, _h("n")), ("a", 2, _h("x")), ("a", 2, _h("x")), ("a", 2, _h("y"))]
    rows += [("b", 5, _h("same"))] * 40
    assert _got(spark, rows, levels=1) == _manifest(rows)
    assert _got(spark, rows[:1], levels=2) == _manifest(rows[:1])


def test_many_trees(spark):
    rows = [(f"host{i}", i, _h(str(i))) for i in range(300)]
    assert _got(spark, rows, levels=1) == _manifest(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "source string, doc_id long, leaf string")
    assert merkle.manifest(frame, "source", "doc_id", "leaf").count() == 0


def test_leaf_of_nulls_long_texts_and_accents(spark):
    rows = [(1, None, ""), (None, "é", "x" * 300_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r[0] for r in frame.select(merkle.leaf(*(F.col(c) for c in frame.columns))).collect()}
    assert got == {_h("1:1-0:"), _h("-2:é300000:" + "x" * 300_000)}
