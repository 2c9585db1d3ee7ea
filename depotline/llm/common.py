"""What several operators of this package share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of the contracts: runs without the six white-space characters of ASCII.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Every order by content is cut into so many hash buckets; sums over them stay this small.
BUCKETS = 16_384


def fresh(rows: DataFrame, *wanted: str) -> list[str]:
    """Column names that the rows do not have yet, one per wanted name."""
    taken = {c.lower() for c in rows.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def plain(text: Column | str) -> Column:
    """The text, empty where it is null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column, F.lit(""))


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo the divisor; a null id counts as empty text."""
    return F.crc32(plain(F.col(doc_id).cast("string"))) % divisor


def word_count(text: str) -> Column:
    """Number of words, as a long; 0 for null."""
    return F.regexp_count(plain(text), F.lit(WORD)).cast("long")


def lower_ascii(word: Column) -> Column:
    """Lower-cases A-Z and nothing else. The quick way is open to words of ASCII alone."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, UPPER.lower()))


def bucket_of(*parts: Column) -> Column:
    """One of BUCKETS, fixed by the parts' text alone."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % BUCKETS)


def token(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, as UTF-8; bytes.split knows ASCII white space only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


SENTENCE_END = re.compile(r"[.!?\n]+")
