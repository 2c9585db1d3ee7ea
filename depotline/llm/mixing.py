"""Mixing sources to target weights by pivotal rounding of fractional copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotline.llm.common import fresh, word_count
from depotline.llm.numbering import in_order
from depotline.session import written

# Documents that one step of the reduction tree folds.
FOLD = 64
# Rows of a source and size class that wait for the last fold: with at most 63 classes, a list
# of that fold is below 4,200 rows.
HELD = 64
# Most copies of a document.
MOST = 3


def targets(sizes: DataFrame, source: str, size: str) -> DataFrame:
    """One row per source: its weight, and `target` words.

    Sources by code point, null last, weigh 1, 2, 3 in turn and share all words; a target
    stops at MOST times the source's words and the rest is shared by weight again. That ends
    where every target is min(cap, level * weight). The level is found from below: each round
    shares what the sources capped so far leave over, which caps more of them, until none is added.
    Rounds send three sums to the driver; sources are ranked by ranges, so there may be any number.
    """
    named = sizes.select(F.lit("").alias("tree"), F.col(source).isNull().alias("_last"),
                         F.coalesce(F.col(source), F.lit("")).alias("_name"), F.lit(1).alias("n"),
                         F.col(source), F.col(size))
    weighed = written(in_order(named, ["_last", "_name"], "mixing").select(
        source, size, (F.col("first") % 3 + 1).cast("int").alias("weight")), "mixing")
    cap = MOST * F.col(size)
    level, before = 0.0, -1
    while True:
        open_ = cap > F.lit(level) * F.col("weight")
        words, capped, weight, closed = weighed.agg(
            F.sum(size), F.sum(F.when(~open_, cap)), F.sum(F.when(open_, F.col("weight"))),
            F.count_if(~open_)).first()
        if not weight or closed == before:
            break
        level, before = (float(words) - float(capped or 0)) / weight, closed
    return weighed.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _fold(items: Column, seed: int, level: int) -> Column:
    """Pivotal rounding along a short array of structs (size, part, rest...).

    The state holds one open item and the closed ones. A step moves words between the open
    and the next item, up or down with odds that keep both expectations, until one of them
    has no copy or a whole one; the other stays open. Words in sum never change.
    """
    first = F.struct(items[0].alias("open"), F.slice(items, 1, 0).alias("closed"))

    def step(state: Column, item: Column) -> Column:
        pair = F.struct(state["open"].alias("a"), item.alias("b"))
        return F.transform(F.array(pair), lambda p: _meet(state, p["a"], p["b"]))[0]

    def _meet(state: Column, a: Column, b: Column) -> Column:
        mass_a, mass_b = a["size"] * a["part"], b["size"] * b["part"]
        room_a, room_b = a["size"] - mass_a, b["size"] - mass_b
        moves = F.struct(F.least(room_a, mass_b).alias("up"), F.least(mass_a, room_b).alias("down"),
                         _uniform(F.lit(seed), F.lit(level), a["tag"], b["tag"]).alias("u"))

        def settled(m: Column) -> Column:
            rises = m["u"] * (m["up"] + m["down"]) < m["down"]
            # What the move leaves: exactly 0 or 1 on the side that it closes.
            a_closes = F.when(rises, room_a <= mass_b).otherwise(mass_a <= room_b)
            moved = F.when(rises, m["up"]).otherwise(-m["down"])
            new_a = F.when(a_closes, F.when(rises, 1.0).otherwise(0.0)).otherwise(
                a["part"] + moved / a["size"])
            new_b = F.when(a_closes, b["part"] - moved / b["size"]).otherwise(
                F.when(rises, 0.0).otherwise(1.0))
            done_a, done_b = a.withField("part", new_a), b.withField("part", new_b)
            return F.struct(
                F.when(a_closes, done_b).otherwise(done_a).alias("open"),
                F.concat(state["closed"],
                         F.array(F.when(a_closes, done_a).otherwise(done_b))).alias("closed"))

        return F.transform(F.array(moves), settled)[0]

    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), first, step)


def copies(rows: DataFrame, source: str, size: str, by: list[Column], seed: int = 11) -> DataFrame:
    """The rows with source_size, target (of the source) and `copies` (0 .. MOST).

    A source's rows all get the whole copies of target / source_size; the fraction left is
    rounded in a tree. Rows of one source and size class (powers of two) are folded FOLD at a
    time, a fold leaves one open row, and open rows are folded again until a class has one.
    HELD rows of each class wait for the last fold, over all classes of the source from large
    to small. Its one open row is closed, and what the source's words then differ from their
    target by is made up by the rows of that fold, large ones first, with further copies or
    fewer, never below none or above MOST: what is left is mostly less than the smallest row's
    half. Apart from that every row's expected copies are the exact fraction. All draws are hashes of `by`, the seed and the tree's level, so reruns
    agree; rows equal in `by` are interchangeable.
    Rows without words, a null size among them, get the whole copies and take no part. A null
    source is a source. Columns named source_size, target or copies are replaced. An empty table
    gives an empty one.
    Only the given columns travel through the tree: project long texts away beforehand.
    """
    # Own names for what the tree needs; the columns themselves travel as one.
    kept = [c for c in rows.columns if c.lower() not in ("source_size", "target", "copies")]
    # Read by the sums, the counts and the tree; counting words once is what costs.
    rows = written(rows.select(
        F.struct(*(F.col(c) for c in kept)).alias("_row"), F.col(source).alias("_of"),
        F.coalesce(F.col(size), F.lit(0)).alias("_size"), *_renamed(by)), "mixing")
    source, size, by = "_of", "_size", [F.col(f"_by{i}") for i in range(len(by))]
    sizes = rows.groupBy(source).agg(F.sum(size).alias("source_size"))
    # One short row per source; the join's other side is matched by equality, null-safe.
    plan = targets(sizes.withColumnRenamed(source, "_source"), "_source", "source_size").select(
        "_source", "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = (rows.join(plan, F.col(source).eqNullSafe(F.col("_source")))
               .withColumn("_rate", rate).withColumn("_whole", F.floor("_rate").cast("int"))
               .withColumn("_part", F.col("_rate") - F.col("_whole")))
    carried = ["_row", "source_size", "target", "_whole"]
    joins = (F.col("_part") > 0) & (F.col(size) > 0)
    settled = planned.filter(~joins).select(*carried, F.lit(0).alias("_more"))

    size_class = F.floor(F.log2(F.col(size))).cast("int")
    counts = (rows.filter(F.col(size) > 0)
              .groupBy(F.col(source).alias("_s"), size_class.alias("_c"))
              .agg(F.count("*").alias("_rows")))
    items = (planned.filter(joins)
             .select(F.col(source).alias("_s"), size_class.alias("_c"),
                     F.struct(F.col(size).cast("double").alias("size"),
                              F.col("_part").alias("part"),
                              F.xxhash64(F.lit(seed), *by).alias("tag"),
                              F.struct(*carried).alias("row")).alias("_item"), *by))
    # A place in a hash bucket of the class, so that no fold is longer than FOLD even where
    # rows are equal. There is one row of counts per source and class.
    items = items.join(counts.withColumnsRenamed({"_s": "_s2", "_c": "_c2"}),
                       F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_c") == F.col("_c2")))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("_rows") / (FOLD * FOLD)))
    items = items.withColumn("_b", F.pmod(F.col("_item.tag"), buckets))
    within = Window.partitionBy("_s", "_c", "_b").orderBy(
        F.col("_item.tag"), *(F.col(f"_by{i}") for i in range(len(by))))
    items = items.withColumn("_place", F.row_number().over(within) - 1)
    wait = (F.col("_b") == 0) & (F.col("_place") < HELD)
    items = written(items.withColumn("_waits", wait).select(
        "_s", "_c", "_waits", F.col("_rows").alias("_left"), "_item",
        F.xxhash64("_b", F.floor(F.col("_place") / FOLD)).alias("_g")), "mixing")
    open_items = items.filter(~F.col("_waits")).drop("_waits")

    # Rows that may still be open in a class: one per fold of the first level, and after each
    # further level one per group. A group gets FOLD / 2 of them on average, hashed.
    most = counts.agg(F.max("_rows")).first()[0] or 0
    left, level, closed = _folds(most), 0, []
    while most:
        # Written, as the closed rows and the next level both read it.
        folded = written(_folded(open_items, ["_s", "_c", "_g"], seed, level), "mixing")
        closed.append(folded.select(F.explode("_state.closed").alias("_item")))
        bound = F.col("_left") if level else _folds(F.col("_left"))
        groups = F.ceil(bound / (FOLD // 2))
        open_items = folded.select(
            "_s", "_c", F.pmod(F.xxhash64(F.lit(level), "_g"), groups).alias("_g"),
            groups.alias("_left"), F.col("_state.open").alias("_item"))
        level += 1
        if left == 1:
            break
        left = -(-left // (FOLD // 2)) if level > 1 else left
    if most:
        last = items.filter("_waits").select("_s", "_left", "_item").unionByName(
            open_items.select("_s", "_left", "_item"))
        last = written(_folded(last, ["_s"], seed, level), "mixing")
        drawn = _uniform(F.lit(seed), F.lit(-1), F.col("_state.open.tag")) < F.col("_state.open.part")
        ended = last.select(F.explode(_closed(F.col("_state"), drawn)).alias("_end"))
        settled = settled.unionByName(ended.select(
            "_end.item.row.*", (F.col("_end.item.part").cast("int") + F.col("_end.change")).alias("_more")))
    for some in closed:
        settled = settled.unionByName(some.select(
            "_item.row.*", F.col("_item.part").cast("int").alias("_more")))
    return settled.select(*(F.col("_row")[c].alias(c) for c in kept), "source_size", "target",
                          (F.col("_whole") + F.col("_more")).cast("int").alias("copies"))


def _corrected(items: Column, missing: Column, nearest: bool) -> Column:
    """What is still missing, and each item's further copies, after a walk from large items to small.

    An item takes as many further copies, or gives up as many, as what is missing has room for, or
    with `nearest` as bring it nearest to none; smaller ones correct what it leaves.
    """
    def step(state: Column, item: Column) -> Column:
        times = state["missing"] / item["size"]
        whole = F.round(times) if nearest else F.when(times < 0, F.ceil(times)).otherwise(F.floor(times))
        held = item["row"]["_whole"] + item["part"].cast("int")
        change = F.greatest(-held, F.least(F.lit(MOST) - held, whole.cast("int")))
        return F.struct((state["missing"] - change * item["size"]).alias("missing"),
                        F.concat(state["changes"], F.array(change)).alias("changes"))

    start = F.struct(missing.alias("missing"), F.array().cast("array<int>").alias("changes"))
    return F.aggregate(items, start, step)


def _closed(state: Column, drawn: Column) -> Column:
    """All items of a source with their last copies, once its one open item is closed.

    The open item gets a copy or not; what the source's words then differ from their target by is
    corrected by the items at hand. Of four ways (closed up or down, corrected with or without
    overshoot) the one counts that leaves least missing, of equal ones the one drawn.
    """
    def way(up: bool, nearest: bool) -> Column:
        last = state["open"].withField("part", F.lit(1.0 if up else 0.0))
        items = F.concat(state["closed"], F.array(last))
        missing = state["open"]["size"] * (state["open"]["part"] - (1.0 if up else 0.0))
        return F.transform(F.array(_corrected(items, missing, nearest)), lambda c: F.struct(
            F.round(F.abs(c["missing"]), 6).alias("left"), (drawn != F.lit(up)).alias("other"),
            F.lit(nearest).alias("nearest"), items.alias("items"), c["changes"].alias("changes")))[0]

    best = F.array_min(F.array(*(way(u, n) for u in (True, False) for n in (False, True))))
    return F.transform(F.array(best), lambda b: F.zip_with(
        b["items"], b["changes"], lambda i, c: F.struct(i.alias("item"), c.alias("change"))))[0]


def _renamed(by: list[Column]) -> list[Column]:
    return [c.alias(f"_by{i}") for i, c in enumerate(by)]


def _folds(rows):
    """Most folds of so many rows at the first level: full ones, and one rest per bucket."""
    if isinstance(rows, Column):
        return F.ceil(rows / (FOLD * FOLD)) + F.ceil(rows / FOLD)
    return -(-rows // (FOLD * FOLD)) + -(-rows // FOLD)


def _folded(items: DataFrame, group: list[str], seed: int, level: int) -> DataFrame:
    """Each group's state after rounding along its items, large ones first."""
    listed = F.sort_array(F.collect_list(F.struct(
        (-F.col("_item.size")).alias("s"), F.col("_item.tag").alias("t"),
        F.col("_item").alias("i"))))
    return (items.groupBy(*group).agg(F.max("_left").alias("_left"), listed.alias("_list"))
            .withColumn("_list", F.transform("_list", lambda x: x["i"]))
            .select(*group, "_left", _fold(F.col("_list"), seed, level).alias("_state")))


def sized(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """What the mixing needs of documents: id, source, size in words and a hash of the text."""
    return documents.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                            word_count(text).alias("size"), F.xxhash64(text).alias("text_hash"))


def mixed(documents: DataFrame, seed: int = 11) -> DataFrame:
    """The documents as rows repeated by their copies, with their own columns.

    Rows that are equal in all columns are interchangeable: their copies are added up and
    spread over them as one.
    """
    key, copy = fresh(documents, "_key", "_copies")
    keyed = documents.withColumn(key, F.md5(F.to_json(F.struct(*documents.columns))))
    small = keyed.select(F.col(key).alias("key"), "source", word_count("text").alias("size"))
    taken = (copies(small, "source", "size", [F.col("key")], seed).groupBy("key")
             .agg(F.sum("copies").alias(copy)).filter(F.col(copy) > 0)
             .withColumnRenamed("key", key))
    # Equal rows as one, then repeated: both sides are dealt by the key, once.
    return (keyed.dropDuplicates([key]).join(taken, key)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy).cast("int"))))
            .select(*documents.columns))
