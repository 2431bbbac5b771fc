"""A bounded one-hash filter over a column of 64-bit hashes, to drop most rows that a join would drop, before its shuffle."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most bits of a filter; 8 MB. With more ids than that it lets ever more rows pass, none too few.
MOST_BITS = 1 << 26
_PAGE = 4096


class Membership:
    """Which 64-bit hashes may be in a set: no false negatives. Built by Spark, at most MOST_BITS / 8 bytes reach the driver."""

    def __init__(self, hashes: DataFrame, column: str, bits_each: int = 16):
        spark = hashes.sparkSession
        hashed = hashes.select(F.col(column).alias("_h"))
        count = hashed.count()
        self.bits = min(MOST_BITS, 1 << max(15, math.ceil(math.log2(bits_each * max(count, 1)))))
        place = (F.pmod("_h", F.lit(self.bits)) + 1).alias("_x")
        pages = hashed.select(place).groupBy(F.expr("bitmap_bucket_number(_x)").alias("page")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(_x))").alias("bits")
        )
        whole = np.zeros(max(self.bits // 8, _PAGE), np.uint8)
        for row in pages.collect():
            held = np.frombuffer(bytes(row["bits"]), np.uint8)
            whole[(row["page"] - 1) * _PAGE : (row["page"] - 1) * _PAGE + len(held)] = held
        self._shared = spark.sparkContext.broadcast(whole.tobytes())

    def possible(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash whether its id may be in the set."""
        bitmap = np.frombuffer(self._shared.value, np.uint8)
        place = hashes % np.int64(self.bits)  # the sign of the divisor, as pmod
        return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
