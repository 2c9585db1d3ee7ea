"""Near copies of which one repeats a line."""

import random

from depotline.llm import near_duplicates


def test_a_repeated_line_does_not_part_near_copies(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        body = " ".join(f"b{i}_{rng.randrange(10 ** 6)}" for _ in range(64))
        line = " ".join(f"l{i}_{k}" for k in range(6))
        # 60 shared shingles and 10 more: a set similarity of 0.857.
        rows += [(2 * i, body), (2 * i + 1, body + f"\n{line}" * 50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}
