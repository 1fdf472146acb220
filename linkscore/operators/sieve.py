"""A Bloom filter of known keys, built and applied with built-in functions.

Rows of unknown devices then leave at the scan, before an aggregation shuffles them; the exact join
that follows removes the few that pass by chance. The filter is a table of 64-bit words: a key's
hash names one word, and a second hash a few bits of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64
#: Bits set by a key, and bits of the filter per key: about one unknown key in 150 passes.
SET_BITS, BITS_PER_KEY = 4, 16
#: The most words a filter has: 8 MB of bits, about 100 MB as a broadcast table.
MAX_WORDS = 1 << 20


@dataclass(frozen=True)
class Sieve:
    bits: DataFrame
    words: int
    types: tuple[str, ...]


def _types(df: DataFrame, columns: Sequence[str]) -> tuple[str, ...]:
    return tuple(df.select(c).schema[0].dataType.simpleString() for c in columns)


def _place(columns: Sequence[str], words: int) -> tuple[Column, Column]:
    """The key's word, and its bits there."""
    bits = F.xxhash64(F.lit(SET_BITS), *columns)

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * k).bitwiseAND(F.lit(WORD - 1)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return F.pmod(F.xxhash64(*columns), F.lit(words)), reduce(Column.bitwiseOR, (bit(k) for k in range(SET_BITS)))


def known_keys(keys: DataFrame, columns: Sequence[str], max_words: int = MAX_WORDS) -> Sieve | None:
    """The filter of the keys in ``columns``; keys with a null, which meet nothing in a join, are left out.

    Its size follows the estimated number of keys. More keys than ``max_words`` hold at half the usual
    bits per key give no filter, since most rows would pass it: the rows then go on unfiltered.
    """
    keys = keys.select(*columns).dropna()
    n = keys.agg(F.approx_count_distinct(F.struct(*columns))).first()[0]
    words = 1 << max(0, -(-n * BITS_PER_KEY // WORD) - 1).bit_length()
    if words > 2 * max_words:
        return None
    words = min(words, max_words)
    word, mask = _place(columns, words)
    bits = keys.groupBy(word.alias("_sieve_word")).agg(F.bit_or(mask).alias("_sieve_bits"))
    return Sieve(bits, words, _types(keys, columns))


def passing(rows: DataFrame, sieve: Sieve | None, columns: Sequence[str]) -> DataFrame:
    """The rows whose key may be known: all known ones, and a few others. All rows without a filter.

    The words are broadcast; there are ``MAX_WORDS`` at most, whatever the number of keys.
    """
    if sieve is None:
        return rows
    if _types(rows, columns) != sieve.types:
        raise ValueError(f"keys of {sieve.types} against {_types(rows, columns)}")
    word, mask = _place(columns, sieve.words)
    meets = (word == F.col("_sieve_word")) & (F.col("_sieve_bits").bitwiseAND(mask) == mask)
    return rows.join(F.broadcast(sieve.bits), meets, "left_semi")
