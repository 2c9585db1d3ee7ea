"""The operators of this package bound to the given tables, by the names of the contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.llm import (
    common,
    decontamination,
    language_model,
    merkle,
    mixing,
    near_duplicates,
    packing,
    paragraphs,
    ranking,
    rules,
    sharding,
    spelling,
    toxicity,
    wrappers,
)
from depotline.llm.common import id_remainder, plain
from depotline.session import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = """list_filter(string_split_regex(translate(coalesce(text, ''),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""

_DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
-- Windows of the items, by number of words.
win AS (SELECT DISTINCT item, least(len(w), 13) AS n,
  array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
 FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
 FROM (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
found AS (SELECT DISTINCT k, item, i, n FROM grams JOIN win USING (n, g)),
words AS (SELECT k, count(DISTINCT p) AS n_hit
 FROM (SELECT k, unnest(range(i, i + n)) AS p FROM found) GROUP BY k),
named AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
 FROM (SELECT DISTINCT k, item FROM found) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
 CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN named USING (k)"""


@_query(_DECONTAMINATION_SQL)
def op1_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, and the verdict."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.judged(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated")


# Words are cut at ASCII white space only; lines with a word are told apart by their whole text.
_RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (SELECT k, i, w[i : i + 2] AS g
 FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
again AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY k),
lines AS (SELECT k, count(*) - count(DISTINCT x) AS dup, count(*) AS n
 FROM (SELECT k, unnest(string_split(t, chr(10))) AS x FROM d)
 WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY k),
b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  coalesce(lines.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS capitals,
  length(regexp_replace(t, '[^!]+', '', 'g')) AS shouts
 FROM w LEFT JOIN rep USING (k) LEFT JOIN lines USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
  OR 2 * n_dup_lines > n_lines OR 10 * capitals > 3 * word_chars OR 10 * shouts > 3 * n_words
  OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words) AS kept
FROM b"""


@_query(_RULES_SQL)
def op2_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the cascade's verdict."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = rules.screened(docs, with_counts=True)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


def _scores(found: DataFrame, threshold: float) -> DataFrame:
    return found.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


@_query()
def op3_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _scores(ranking.scored(docs, _table(spark, sf_dir, "labels")), 0.5)


@_query()
def op6_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _scores(toxicity.scored(docs, _table(spark, sf_dir, "labels")), toxicity.THRESHOLD)


@_query()
def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shards hold equal row counts up to one."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(plain("text")) + 1).cast("long").alias("size"),
        F.crc32(plain("text")).alias("text_crc32"))
    by = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return sharding.sharded(docs, by).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query()
def op7_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = mixing.sized(_table(spark, sf_dir, "documents"))
    by = [F.col("doc_id"), F.col("text_hash"), F.col("size")]
    return mixing.copies(docs, "source", "size", by).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


@_query()
def op5_probminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return near_duplicates.near_duplicates(
        _table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query()
def op8_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that repeat within or across documents."""
    return paragraphs.repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query()
def op9_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return language_model.scored(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query()
def op10_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.extracted(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def _crc32_sql(text: str) -> str:
    """SQL for the unsigned crc32 of a text of letters up to U+00FF outside the C1 signs, bit by bit."""
    turns = ", ".join(["-1"] * 8)
    return f"""xor(list_reduce(flatten(list_transform(string_split({text}, ''),
 lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT), {turns}]
  ELSE [195, {turns}, CAST(unicode(c) - 64 AS BIGINT), {turns}] END)),
 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END,
 CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _merkle_sql(levels: int = 5) -> str:
    """Trees of up to 16 ** levels nodes, level by level."""
    def climb(name: str, tree: str) -> list[str]:
        """Nodes by level; a finished tree's node moves up as it is."""
        found = []
        for i in range(levels):
            found.append(f"""{name}{i + 1} AS (SELECT {tree}, pos // 16 AS pos,
 CASE WHEN any_value(size) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
 CASE WHEN any_value(size) > 1 THEN (any_value(size) + 15) // 16 ELSE 1 END AS size
 FROM {name}{i} GROUP BY {tree}, pos // 16)""")
        return found

    def steps(name: str, tree: str, start: str, i: int) -> str:
        """One leaf's siblings of a level, and the hash of its run with its own digest put in."""
        return f"""{name}_p{i + 1} AS (SELECT p.k, p.{tree}, any_value(p.pos) // 16 AS pos,
 any_value(p.proof) || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> p.pos), '') AS proof,
 CASE WHEN any_value(n.size) > 1 THEN sha256(string_agg(CASE WHEN n.pos = p.pos THEN p.h ELSE n.h END, '' ORDER BY n.pos))
  ELSE any_value(p.h) END AS h
 FROM {start} p JOIN {name}{i} n ON n.{tree} = p.{tree} AND n.pos // 16 = p.pos // 16
 GROUP BY p.k, p.{tree})"""

    parts = [f"""d AS (SELECT row_number() OVER (ORDER BY doc_id, source, lang, text) AS k, doc_id,
 coalesce('s' || source, '-') AS tree, source, {_leaf_sql('text')} AS leaf,
 CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
  THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
  ELSE {_leaf_sql('text')} END AS tampered FROM documents)""",
             """l0 AS (SELECT k, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos,
 leaf AS h, count(*) OVER (PARTITION BY tree) AS size FROM d)"""]
    parts += climb("l", "tree")
    parts.append("l0_p0 AS (SELECT l0.k, l0.tree, pos, '' AS proof, d.tampered AS h FROM l0 JOIN d USING (k))")
    start = "l0_p0"
    for i in range(levels):
        parts.append(steps("l", "tree", start, i))
        start = f"l_p{i + 1}"
    parts.append(f"""t0 AS (SELECT 0 AS top, tree, h, row_number() OVER (ORDER BY tree <> '-', tree) - 1 AS pos,
 count(*) OVER () AS size FROM l{levels})""")
    parts += climb("t", "top")
    parts.append(f"""t0_p0 AS (SELECT p.k, 0 AS top, t0.pos, p.proof, p.h FROM {start} p JOIN t0 USING (tree))""")
    start = "t0_p0"
    for i in range(levels):
        parts.append(steps("t", "top", start, i))
        start = f"t_p{i + 1}"
    body = ",\n".join(parts)
    return f"""WITH {body}
SELECT d.doc_id, d.leaf, t0.h AS subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root,
 p.h = r.h AS verified
FROM d JOIN {start} p USING (k) JOIN t0 USING (tree) CROSS JOIN t{levels} r"""


@_query(_merkle_sql())
def op11_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a tampered copy is found out."""
    text = F.col("text")
    lower = F.translate(text, common.UPPER, common.UPPER.lower())
    # A number id's text; a null id is empty text.
    hit = id_remainder("doc_id", 5) == 0
    docs = _table(spark, sf_dir, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select("doc_id", "source", merkle.leaf(*values, text).alias("leaf"),
                         F.when(hit, merkle.leaf(*values, lower)).alias("tampered"))
    found = merkle.manifest(leaves, "source", "doc_id", "leaf", ("tampered",))
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select("doc_id", "leaf", "subroot", "root",
                        merkle.hashed(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
                        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


@_query()
def op12_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(written(packing.pieces(docs), "pieces"))


_VARIANTS_SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
 FROM documents),
d AS (SELECT run, n, {_crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
 FROM (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run)),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0
  THEN left(run, h % length(run)) || substr(run, CAST(h % length(run) + 2 AS INT)) ELSE run END AS word FROM d)
 GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
cuts AS (SELECT word, n, i, left(word, i) AS a, substr(word, CAST(i + 2 AS INT)) AS z
 FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (SELECT DISTINCT x.word, x.n, y.word AS near, y.n AS near_n
  FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
 UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN w ON w.word = c.a || c.z
 UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN w ON w.word = c.a || c.z),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
  CASE WHEN form_n >= 2 * w.n THEN (SELECT min(near) FROM near WHERE near.word = w.word AND near_n = form_n) END AS form,
  CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
 FROM w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form AS onward FROM f
 UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.onward)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN walk ON walk.word = f.word AND onward IS NULL"""


@_query(_VARIANTS_SQL)
def op13_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling.variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))
