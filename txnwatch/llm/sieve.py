"""A fixed-size bitmap of 64-bit hashes: tells what certainly isn't among some keys.

Its size follows the number of keys up to a fixed most, so it may travel with the tasks. Hashes
that it lets through by mistake cost a comparison later; none that belongs to a key is held back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 13, 26
"""Powers of two: 1 kB to 8 MB."""


def build(keys: DataFrame, column: str = "key") -> np.ndarray:
    """The bitmap of a long column's values, added up by Spark, as words of 64 bits."""
    wanted = max(1, keys.count() * BITS_PER_KEY)
    size = min(MOST_BITS, max(LEAST_BITS, (wanted - 1).bit_length()))
    cells = keys.select(F.shiftrightunsigned(F.col(column), 64 - size).alias("cell"))
    words = cells.groupBy(F.expr("cast(cell >> 6 AS int)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(cell & 63 AS int)))").alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (size - 6), np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def maybe(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned 64-bit hashes may be among the keys."""
    cells = hashes >> np.uint64(64 - (len(bitmap).bit_length() - 1 + 6))
    return (bitmap[(cells >> np.uint64(6)).astype(np.int64)] >> (cells & np.uint64(63)) & np.uint64(1)).astype(bool)


def maybe_column(bitmap: np.ndarray, key: Column) -> Column:
    """The same for a long column."""
    import pyarrow as pa

    @F.arrow_udf("boolean")
    def test(keys: pa.Array) -> pa.Array:
        return pa.array(maybe(bitmap, keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    return test(key)
