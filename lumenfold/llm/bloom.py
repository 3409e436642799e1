"""A Bloom filter of bounded size from a column of hashes; more keys only let more false candidates through."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 24, 27


class Bloom:
    def __init__(self, hashes: DataFrame, column: str, count: int):
        """count: about how many keys there are; at most 2^MAX_BITS bits are used."""
        self.bits = min(MAX_BITS, max(MIN_BITS, int(np.ceil(np.log2(count * 48 + 1)))))
        at = F.explode(F.array(F.shiftrightunsigned(column, 64 - self.bits), F.col(column).bitwiseAND((1 << self.bits) - 1)))
        # one row per 64 bits of the filter: at most 2^(MAX_BITS - 6)
        rows = hashes.select(at.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("v")).toPandas()
        filled = np.zeros(1 << (self.bits - 6), np.uint64)
        filled[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).view(np.uint64)
        self.words = filled

    def find(self, s: np.ndarray) -> np.ndarray:
        """Positions of the hashes (uint64) that may be in the filter."""
        one = (s >> np.uint64(64 - self.bits)).astype(np.int64)
        maybe = np.flatnonzero((self.words[one >> 6] >> (one & 63).astype(np.uint64)) & np.uint64(1))
        two = (s[maybe] & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return maybe[((self.words[two >> 6] >> (two & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)]
