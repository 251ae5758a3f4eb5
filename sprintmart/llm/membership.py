"""A filter of fixed size that most rows without a partner in a join do not pass."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length of the bitmap, whatever the number of keys: one MB. Where keys fill it, all rows pass.
BITS = 1 << 23


def may_have(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test of 64-bit hashes: false only for values that are not in the column.

    The bitmap is put together by an aggregation of at most ``BITS`` / 64 groups, which is what the driver
    receives. The test spares rows a shuffle; the join behind it decides.
    """
    place = F.pmod(F.col(column), F.lit(BITS))
    word, bit = F.shiftright(place, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")
    rows = keys.where(F.col(column).isNotNull()).groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(BITS // 64, np.uint64)
    bitmap[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    packed = bitmap.tobytes()

    @F.arrow_udf("boolean")
    def test(values: pa.Array) -> pa.Array:
        own = np.frombuffer(packed, np.uint64)
        at = values.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(BITS)
        found = (own[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return pa.array(found.astype(bool))

    return test
