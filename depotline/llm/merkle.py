"""Merkle manifest of a table: a tree per group of rows, and a tree over the groups' roots.

Every FANOUT consecutive nodes become their hash until one node remains. Rows are cut into
aligned blocks of FANOUT ** LEVELS leaves; a block hashes its own levels alone. Above them the
blocks trade subtree roots in a butterfly: in each round the FANOUT subtrees of a group swap
their roots, and every block hashes the parent for itself, so it gains one level of its proofs
with each round and no pass leads down again.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.llm.numbering import in_order
from depotline.session import written

FANOUT = 16
# Levels that a block of leaves hashes alone: 16 ** 3 leaves, about 600 KB of digests.
LEVELS = 3
# Blocks of one group that share a copy of the group's own proof.
SHARED = 1_024
# Rows that a task hands on at once.
HANDED = 512

_PROOF = "array<struct<place: int, siblings: string>>"


def hashed(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes, in lowercase hex."""
    return F.sha2(text.cast("binary"), 256)


def field(column: Column) -> Column:
    """A value with its length in bytes in front; `-` for null."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    """The digest of a row's values, in the given order."""
    return hashed(F.concat(*map(field, columns)))


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(proof, digest, lambda held, step: hashed(F.concat(
        F.substring(step["siblings"], F.lit(1), step["place"] * 64), held,
        F.substring(step["siblings"], step["place"] * 64 + 1, F.length(step["siblings"])))))


def siblings(proof: Column) -> Column:
    """All siblings of a path from the leaf upwards, as one text."""
    return F.array_join(F.transform(proof, lambda step: step["siblings"]), "")


def _raised(nodes: list[str]) -> list[str]:
    return [sha256("".join(nodes[i:i + FANOUT]).encode()).hexdigest()
            for i in range(0, len(nodes), FANOUT)]


def _levels(leaves: list[str], size: int, levels: int) -> list[list[str]]:
    """A block's nodes by level; a tree that fits one block ends where one node remains."""
    found = [leaves]
    for _ in range(levels):
        if size <= FANOUT ** levels and len(found[-1]) == 1:
            break
        found.append(_raised(found[-1]))
    return found


def _block_roots(placed: DataFrame, levels: int) -> DataFrame:
    """(tree, block, size in blocks, digest) of every block of leaves."""
    def work(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at")
        size = rows["size"][0].as_py()
        top = _levels(rows["leaf"].to_pylist(), size, levels)[-1][0]
        return pa.table({"tree": rows["tree"][:1], "at": rows["block"][:1],
                         "size": pa.array([-(-size // FANOUT ** levels)], pa.int64()),
                         "digest": pa.array([top])})

    return placed.select("tree", "block", "at", "size", "leaf").groupBy("tree", "block").applyInArrow(
        work, "tree string, at long, size long, digest string")


def butterfly(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, at, size, digest) with `root`, their tree's root, and `proof`, their path to it.

    `at` counts a tree's nodes from 0, `size` says how many there are. In the round of span s a
    node stands for the subtree of s nodes that it lies in, whose root it holds. It meets one
    node of each other subtree under the same parent: the one with its own place in the subtree,
    or, where the last subtree is not full, one of those there are in turn. At most FANOUT
    digests meet; the most nodes of a tree are the one number that reaches the driver.
    """
    most = nodes.agg(F.max("size")).first()[0] or 0
    now = nodes.select("tree", "at", "size", F.col("digest").alias("root"),
                       F.array().cast(_PROOF).alias("proof"))
    span = 1
    while span < most:
        low, digit = F.col("at") % span, F.floor(F.col("at") / span) % FANOUT
        full = F.col("at") - low + span <= F.col("size")
        # A subtree that is not full answers for the places it lacks; the first of a group need not.
        lacking = F.sequence(low, F.lit(span - 1), F.col("size") % span)
        sent = now.withColumn("_low", low).withColumn("_digit", digit.cast("int")).withColumn(
            "_to", F.explode(F.when(full | (digit == 0), F.array(low)).otherwise(lacking)))
        own = F.col("_to") == F.col("_low")
        met = sent.groupBy("tree", F.floor(F.col("at") / (span * FANOUT)).alias("_group"), "_to").agg(
            F.sort_array(F.collect_list(F.struct(
                F.col("_digit").alias("digit"), "root", own.alias("own"),
                F.when(own, F.col("at")).alias("at"),
                F.when(own, F.col("proof")).alias("proof")))).alias("_met"),
            F.first("size").alias("size"))
        # A tree whose one subtree holds all its nodes is finished.
        more = F.col("size") > span
        parent = hashed(F.array_join(F.transform("_met", lambda m: m["root"]), ""))
        step = F.array(F.struct(
            F.col("_me.digit").alias("place"),
            F.array_join(F.transform(
                F.filter("_met", lambda m: m["digit"] != F.col("_me.digit")),
                lambda m: m["root"]), "").alias("siblings")))
        now = (met.withColumn("_parent", parent)
               .withColumn("_me", F.explode(F.filter("_met", lambda m: m["own"])))
               .select("tree", F.col("_me.at").alias("at"), "size",
                       F.when(more, F.col("_parent")).otherwise(F.col("_me.root")).alias("root"),
                       F.when(more, F.concat("_me.proof", step)).otherwise(F.col("_me.proof")).alias("proof")))
        span *= FANOUT
    return now


def _paths(leaves: list[str], size: int, levels: int) -> Iterator[list[dict]]:
    """Every leaf's path inside its block; one list of siblings serves all leaves of a run."""
    nodes = _levels(leaves, size, levels)
    for i in range(len(leaves)):
        path = []
        for level in nodes[:-1]:
            place, start = i % FANOUT, i - i % FANOUT
            path.append({"place": place, "siblings": "".join(
                level[start:i] + level[i + 1:start + FANOUT])})
            i //= FANOUT
        yield path


def manifest(rows: DataFrame, tree: str, order: str, digest: str, carried: tuple[str, ...] = (),
             levels: int = LEVELS) -> DataFrame:
    """Every row's leaf, its tree's subroot, the root over all trees, and the path to the root.

    A tree holds the rows that are equal in `tree` (a string; null is a tree of its own), ascending
    by `order` (nulls first), then by `digest`, the leaf's 64 hex digits. Trees ascend by their
    name, null first, bytewise. Returned: `tree`, `order`, `digest` and the `carried` columns under
    their own names, `subroot`, `root` and `proof`, the steps (place in the run, the run's other
    digests as one text) from the leaf up; other columns are left out. Rows that are equal in all
    of these take neighbouring places, in any order. An empty table gives an empty one.
    Lost executors: what a later step reads is a written table.
    """
    kept = [order, *carried]
    named = rows.select(field(F.col(tree)).alias("tree"), F.col(digest).alias("leaf"),
                        *(F.col(c).alias(f"_{i}") for i, c in enumerate(kept)))
    extra = [f"_{i}" for i in range(len(kept))]
    # Equal rows are one row with a count, so that no range is made of copies alone.
    folded_rows = named.groupBy("tree", "leaf", *extra).agg(F.count("*").alias("n"))
    ordered = in_order(folded_rows, ["_0", "leaf", *extra[1:]], "merkle-rows")
    places = F.explode(F.sequence("first", F.col("first") + F.col("n") - 1))
    placed = written(ordered.select("tree", "leaf", *extra, "size", places.alias("at")).withColumn(
        "block", F.floor(F.col("at") / FANOUT ** levels).cast("long")), "merkle-leaves")

    blocks = written(butterfly(written(_block_roots(placed, levels), "merkle-roots")), "merkle-blocks")
    trees = blocks.filter("at = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"),
        F.ceil(F.col("size") / SHARED).alias("shares"), F.lit(1).alias("n"),
        F.expr("substring(tree, locate(':', tree) + 1)").alias("text"), (F.col("tree") != "-").alias("known"))
    numbered = in_order(trees, ["known", "text", "name"], "merkle-trees").withColumnRenamed("first", "at")
    above = butterfly(numbered.select("tree", "at", "size", "digest"))
    # A tree of many blocks gets a copy of its path for every SHARED of them.
    tops = written(numbered.select("at", "name", "shares", F.col("digest").alias("subroot")).join(
        above.select("at", "root", F.col("proof").alias("_above")), "at"), "merkle-tops").select(
        F.col("name").alias("tree"), "subroot", "root", "_above",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    upper = (blocks.select("tree", F.col("at").alias("block"), "proof",
                           F.floor(F.col("at") / SHARED).cast("long").alias("share"))
             .join(tops, ["tree", "share"])
             .select("tree", "block", "subroot", "root", F.concat("proof", "_above").alias("above")))

    types = dict(placed.dtypes)
    schema = (", ".join(f"{e} {types[e]}" for e in extra)
              + f", tree string, leaf string, subroot string, root string, proof {_PROOF}")
    path_type = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))

    def work(mine: pa.Table, top: pa.Table) -> pa.Table:
        found = mine.sort_by("at")
        n, own = found.num_rows, top.slice(0, 1).to_pylist()[0]
        leaves = found["leaf"].to_pylist()
        parts, held = [], []
        for path in _paths(leaves, found["size"][0].as_py(), levels):
            held.append(path + own["above"])
            if len(held) == HANDED:
                parts.append(pa.array(held, path_type))
                held = []
        parts.append(pa.array(held, path_type))
        return pa.table({**{e: found[e] for e in extra}, "tree": found["tree"], "leaf": found["leaf"],
                         "subroot": pa.array([own["subroot"]] * n), "root": pa.array([own["root"]] * n),
                         "proof": pa.chunked_array(parts, path_type)})

    proven = (placed.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block"))
              .applyInArrow(work, schema))
    name = F.when(F.col("tree") != "-", F.expr("substring(tree, locate(':', tree) + 1)"))
    return proven.select(name.alias(tree), F.col("leaf").alias(digest),
                         *(F.col(e).alias(c) for e, c in zip(extra, kept, strict=True)),
                         "subroot", "root", "proof")
