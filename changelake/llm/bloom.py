"""Bloom filters of bounded size, which keep rows that a join would drop out of a shuffle.

A filter only ever lets too much through; the join behind it decides. Beyond `MOST` bits
it lets more through, and stays right.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest filter: 16 MB.
MOST = 1 << 27
#: Bits for a value; two of them are set.
SHARE = 16


def bloom(hashes: DataFrame) -> np.ndarray:
    """Filter of the 64-bit hashes in the only column of `hashes`, as 64-bit words."""
    value = F.col(hashes.columns[0])
    number = hashes.count()
    bits = 1 << 12
    while bits < min(MOST, SHARE * number):
        bits *= 2
    places = F.array(value.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(value, 32).bitwiseAND(F.lit(bits - 1)))
    words = (
        hashes.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def maybe(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash, whether it may be in the filter."""
    mask = np.uint64((len(words) << 6) - 1)
    found = np.ones(len(hashes), bool)
    for place in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        found &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found
