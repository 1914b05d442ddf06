"""Leave out rows whose key is surely not in a table, before they are shuffled for the join.

The keys become a Bloom filter of 64-bit words: a key sets three bits of one word. The words are
an ordinary table, broadcast while its checked size is small, so the test is a map-side join on
the word number and a bit test, all of it generated code. The filter lets some strangers through;
the join that follows settles them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.operators.staging import staged

BITS_PER_KEY = 16
#: A larger filter is not broadcast; the rows then go to the join as they are.
MOST_BYTES = 64 << 20
#: Bytes of a word and its number in a task's memory, hash table included.
_WORD_BYTES = 48


class KeyFilter(NamedTuple):
    """(word, bits) rows, written, and how many word numbers there are."""

    words: DataFrame
    size: int
    bytes: int


def _word(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size))


def _bits(key: Column) -> Column:
    """Three bits out of 64, by parts of another hash."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(3)]
    return bit[0].bitwiseOR(bit[1]).bitwiseOR(bit[2])


def key_filter(keys: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY) -> KeyFilter:
    """Filter of the keys of a table; null keys are in none."""
    present = keys.where(F.col(key).isNotNull()).select(key)
    n = present.count()
    size = max(1, -(-n * bits_per_key // 64))
    words = present.groupBy(_word(F.col(key), size).alias("_word")).agg(F.bit_or(_bits(F.col(key))).alias("_bits"))
    return KeyFilter(staged(words, "key_filter"), size, min(n, size) * _WORD_BYTES)


def _marked(rows: DataFrame, key: str, known: KeyFilter) -> DataFrame:
    """Rows with ``_key``: the key if it passes the filter, else null.

    The join that follows must be on this column: one on the key itself would be planned before
    the filter.
    """
    own = _bits(F.col(key))
    passed = F.when(F.col("_bits").bitwiseAND(own) == own, F.col(key))
    return (
        rows.withColumn("_word", _word(F.col(key), known.size))
        .join(F.broadcast(known.words), "_word", "left")
        .select(*rows.columns, passed.alias("_key"))
    )


def perhaps_in(rows: DataFrame, key: str, known: KeyFilter, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Rows whose key may be one of the table; all rows where the filter is too large to broadcast."""
    if known.bytes > most_bytes:
        return rows
    return _marked(rows, key, known).where("_key IS NOT NULL").select(*rows.columns)


def known_rows(rows: DataFrame, keys: DataFrame, key: str, known: KeyFilter | None = None) -> DataFrame:
    """Rows whose key is in the table: filter first, then the semi-join on what is left.

    Worth it where many rows have a key that the table lacks: only rows that pass are shuffled.
    """
    known = known or key_filter(keys, key)
    if known.bytes > MOST_BYTES:
        return rows.join(keys.select(key), key, "left_semi")
    passed = _marked(rows, key, known).where("_key IS NOT NULL")
    return passed.join(keys.select(F.col(key).alias("_key")), "_key", "left_semi").select(*rows.columns)


def unknown_rows(rows: DataFrame, keys: DataFrame, key: str, known: KeyFilter | None = None) -> DataFrame:
    """Rows whose key is not in the table, null keys included: the join sees only what the filter lets through."""
    known = known or key_filter(keys, key)
    if known.bytes > MOST_BYTES:
        return rows.join(keys.select(key), key, "left_anti")
    marked = _marked(rows, key, known)
    doubtful = marked.where("_key IS NOT NULL").join(keys.select(F.col(key).alias("_key")), "_key", "left_anti")
    return marked.where("_key IS NULL").select(*rows.columns).unionByName(doubtful.select(*rows.columns))
