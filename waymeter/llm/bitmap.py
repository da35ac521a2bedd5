"""A set of 64-bit keys as a bitmap of bounded size, to leave out most rows before a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap as a power of two: 1 MB, or 4 MB where keys set two bits each; with more keys up to MOST, 32 MB. Keys beyond
#: that only mean more rows that pass by chance.
LEAST, LEAST_OF_TWO, MOST = 23, 25, 28
#: Bits for a key, so that one in eight is set, or in a bitmap of two bits a key one in four.
BITS_A_KEY = 8


def power_for(keys: int, least: int = LEAST) -> int:
    """Bits of a bitmap for so many keys, as a power of two."""
    return min(MOST, max(least, (max(1, keys) * BITS_A_KEY - 1).bit_length()))


def _gathered(places: DataFrame, power: int) -> np.ndarray:
    """Words of 64 bits from places (p); the bits are gathered by Spark, at most 2 ** power / 64 rows reach the driver."""
    rows = (
        places.select(F.shiftrightunsigned("p", 6).alias("w"), F.expr("1L").alias("one"), (F.col("p") % 64).cast("int").alias("b"))
        .groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, b)")).alias("bits")).toArrow()
    )
    out = np.zeros((1 << power) // 64, np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def placed(key: Column, power: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << power))


def build(df: DataFrame, key: Column, power: int) -> np.ndarray:
    return _gathered(df.select(placed(key, power).alias("p")), power)


def has(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bit at each place (``placed``) is set."""
    place = place.astype(np.int64)
    return (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


def build_both(keys: DataFrame, power: int) -> np.ndarray:
    """Bitmap of 64-bit hashes (the only column) that set two bits each, for ``has_both``."""
    key = F.col(keys.columns[0])
    low = F.shiftrightunsigned(key, 64 - 2 * power).bitwiseAND(F.lit((1 << power) - 1))
    return _gathered(keys.select(F.explode(F.array(F.shiftrightunsigned(key, 64 - power), low)).alias("p")), power)


def has_both(words: np.ndarray, key: np.ndarray) -> np.ndarray:
    power = (len(words) * 64).bit_length() - 1
    first = has(words, key >> np.uint64(64 - power))
    if not first.any():
        return first
    out = np.zeros(first.shape, bool)
    out[first] = has(words, (key[first] >> np.uint64(64 - 2 * power)) & np.uint64((1 << power) - 1))
    return out
