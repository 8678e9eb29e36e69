"""A filter of 64-bit hashes, of one size whatever it holds, that tasks take along.

Two bits stand for a hash, one for its first and one for its last FILTER_BITS bits. What passes may be foreign and has to be
looked up exactly; what does not pass is not in the set.

Defined cases: nulls and repeated hashes change nothing; an empty set lets nothing pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 26


def hash_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """The filter of a column of longs. At most 2 ** (FILTER_BITS - 6) numbers are collected, 8 MB."""
    last = F.col(column).bitwiseAND(F.lit(2**FILTER_BITS - 1))
    bits = hashes.where(F.col(column).isNotNull()).select(F.explode(F.array(F.shiftrightunsigned(column, 64 - FILTER_BITS), last)).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    words = bits.groupBy(F.shiftright("bit", 6).alias("slot")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(2 ** (FILTER_BITS - 6), dtype=np.int64)
    out[words.column("slot").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def passes(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be in the set."""

    def bit(place: np.ndarray) -> np.ndarray:
        return known[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)

    return (bit(values >> np.uint64(64 - FILTER_BITS)) & bit(values & np.uint64(2**FILTER_BITS - 1))).astype(bool)
