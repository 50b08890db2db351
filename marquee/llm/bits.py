"""A filter of fixed size: one bit for each value modulo its length.

Its size does not grow with the data, so it may be broadcast.  A value that
was put in is always found; another may be found by chance, so callers use it
only to leave work out, never to decide a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 26
#: Bits of a page, as Spark's bitmap functions build them.
PAGE = 1 << 15


def bit_filter(values: DataFrame) -> np.ndarray:
    """The filter of the numbers in column ``m``; Spark builds its pages, and
    FILTER_BITS / 8 bytes reach the driver at most."""
    place = F.pmod(F.col("m"), F.lit(FILTER_BITS))
    pages = (values.select(place.alias("p"))
             .select(F.floor(F.col("p") / PAGE).cast("int").alias("page"), F.pmod("p", F.lit(PAGE)).alias("bit"))
             .groupBy("page").agg(F.call_function("bitmap_construct_agg", F.col("bit")).alias("bits")))
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in pages.toLocalIterator():
        out[r["page"] * (PAGE // 8):(r["page"] + 1) * (PAGE // 8)] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def bit_set(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``values`` may be in the filter."""
    p = values.view(np.uint64) % np.uint64(FILTER_BITS)
    return (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
