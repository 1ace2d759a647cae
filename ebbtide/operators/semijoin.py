"""Bounded semi-join reducers: filter a large table by a key set that is too
big to broadcast.

``blocks`` is the one the lists use: a Bloom filter in blocks. The key ranges of a
hash have a block of 512 bits each, broadcast as one row of eight words, and a
key sets one bit in every word of its block; a lookup meets one block. The number
of blocks comes from the number of keys (``BITS_PER_KEY``: under 1% of other keys
pass), up to a bound in bytes, beyond which more of them pass.

``bitmap`` is the plain form with one bit a key.

The keys are hashed into ``bits`` positions and packed 64 to a row with
``bit_or``, so the bitmap has at most ``bits / 64`` rows whatever the number
of keys, and can be broadcast into the large table's scan. A row passes when
its key's bit is set: no key of the set is ever dropped, and a key outside
it passes with probability about ``1 - exp(-n / bits)``. The exact join that
follows removes those false positives, so the reducer only changes how many
rows reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


WORDS = 8
#: Bits of the filter for each key: under 1% false positives.
BITS_PER_KEY = 12
#: Bytes of a block's row in a broadcast, as Spark measures them (dataSize: 136.0).
BLOCK_ROW_BYTES = 136


def n_blocks(n_keys: int, max_bytes: int) -> int:
    """Blocks for ``n_keys`` keys, within ``max_bytes`` of broadcast (0: not even one fits)."""
    wanted = -(-max(n_keys, 1) * BITS_PER_KEY // (64 * WORDS))
    return min(wanted, max_bytes // BLOCK_ROW_BYTES)


def _block(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("long")


def _places(key: Column) -> list[Column]:
    """One of 64 bits for each word, from six bits each of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int") for k in range(WORDS)]


def blocks(keys: DataFrame, key: str, n: int) -> DataFrame:
    """(_block, _word0 .. _word7): the filter of ``keys``, at most ``n`` rows; combined map-side."""
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place)
    marked = keys.select(_block(F.col(key), n).alias("_block"), *[bit(p).alias(f"_word{k}") for k, p in enumerate(_places(F.col(key)))])
    return marked.groupBy("_block").agg(*[F.bit_or(f"_word{k}").alias(f"_word{k}") for k in range(WORDS)])


def keep_listed(df: DataFrame, filter_: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in the filter (broadcast, bounded)."""
    tagged = df.withColumn("_block", _block(F.col(key), n)).join(F.broadcast(filter_), "_block", "inner")
    hit = F.lit(True)
    for k, place in enumerate(_places(F.col(key))):
        hit = hit & (F.call_function("shiftright", F.col(f"_word{k}"), place).bitwiseAND(1) == 1)
    return tagged.filter(hit).select(*df.columns)


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, mask): the set bits of ``keys``, at most ``bits / 64`` rows."""
    slot = _slot(F.col(key), bits)
    return (
        keys.select(
            F.shiftright(slot, 6).alias("_word"),
            F.call_function("shiftleft", F.lit(1).cast("long"),
                            slot.bitwiseAND(63).cast("int")).alias("_bit"),
        )
        .groupBy("_word")
        .agg(F.bit_or("_bit").alias("_mask"))
    )


def keep_members(df: DataFrame, mask: DataFrame, key: str, bits: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in the bitmap (broadcast, bounded)."""
    slot = _slot(F.col(key), bits)
    tagged = df.withColumns({"_word": F.shiftright(slot, 6),
                             "_pos": slot.bitwiseAND(63).cast("int")})
    hit = F.call_function("shiftright", F.col("_mask"), F.col("_pos")).bitwiseAND(1) == 1
    return (
        tagged.join(F.broadcast(mask), "_word", "inner")
        .filter(hit)
        .drop("_word", "_pos", "_mask")
    )
