"""A Bloom filter built from one side's keys and applied where the other side is scanned.

A semi join whose key side is too large to broadcast shuffles every row of the table, also those
without a partner. Here the keys are first folded into a fixed number of 64-bit words: a key's
hash names one word and four bits of it. The words are a scalar subquery, so they are
computed once when the query runs, their size is ``words`` longs whatever the number of keys, and
the test is a filter that the optimizer moves to the scan, below aggregations by the key. The
join behind it is exact, so a false positive costs a shuffled row and nothing else.

A filter of ``words`` words tells ``4 * words`` keys well (less than one row in a hundred passes
wrongly, with twice the keys about one in thirty); beyond, it passes more rows and stays right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: 512 KB: for about 262,000 keys.
WORDS = 1 << 16

#: The words are held by every task as one array.
MAX_WORDS = 1 << 20

_BITS = 4


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(words).cast("long"))


def _mask(key: Column) -> Column:
    """Four bits, six bits of a second hash each."""
    spread = F.xxhash64(key, F.lit(2))
    mask = F.lit(0).cast("long")
    for n in range(_BITS):
        place = F.shiftrightunsigned(spread, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def filter_words(keys: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """One row with the filter of ``keys`` as an array of longs.

    Words without a key come from a range; equal words are combined on the map side.
    """
    if not 1 <= words <= MAX_WORDS:
        raise ValueError(f"words must lie between 1 and {MAX_WORDS}")
    key = F.col(column)
    blank = keys.sparkSession.range(words).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")
    )
    set_bits = keys.where(key.isNotNull()).select(
        _word(key, words).alias("word"), _mask(key).alias("bits")
    )
    filled = blank.unionByName(set_bits).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return filled.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))


def might_contain(
    keys: DataFrame, column: str, key: Column, words: int = WORDS
) -> Column:
    """True for every ``key`` among ``keys[column]``, false for most others; null is false."""
    found = F.get(filter_words(keys, column, words).scalar(), _word(key, words).cast("int"))
    mask = _mask(key)
    return key.isNotNull() & (found.bitwiseAND(mask) == mask)


def semi_join(
    table: DataFrame, keys: DataFrame, column: str = "ticker", words: int = WORDS
) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``keys``; others mostly end at the scan.

    Both sides must have the column in the same type, since the hash depends on it.
    """
    if table.schema[column].dataType != keys.schema[column].dataType:
        raise TypeError(f"{column} differs in type between the table and its keys")
    maybe = table.where(might_contain(keys, column, F.col(column), words))
    return maybe.join(keys.select(column), column, "left_semi")
