"""A set of numbers as bits of bounded number, to spare rows before a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 8 MiB; what the filter lets through in vain is only slower, so a fuller one is still right.
FILTER_BITS = 26
# With the count of the numbers, so many bits for each, up to 64 MiB.
BITS_EACH = 8
MOST_BITS = 29


class BitFilter:
    """A set of numbers as bits of their residues: it may let others through, and loses none."""

    def __init__(self, frame: DataFrame, column: str, count: int = 0) -> None:
        wanted = max(FILTER_BITS, min((BITS_EACH * count - 1).bit_length(), MOST_BITS))
        self._size = 1 << wanted
        place = F.pmod(F.col(column), F.lit(self._size))
        words = (
            frame.select(
                F.floor(place / 64).cast("int").alias("word"), (place % 64).cast("int").alias("bit")
            )
            .groupBy("word")
            .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        )
        found = words.toArrow()
        self.empty = found.num_rows == 0
        packed = np.zeros(self._size // 64, np.int64)
        packed[found["word"].to_numpy()] = found["bits"].to_numpy()
        self._bits = frame.sparkSession.sparkContext.broadcast(packed)

    def holds(self, values: np.ndarray) -> np.ndarray:
        at = values.astype(np.int64) & (self._size - 1)
        return (self._bits.value[at >> 6] >> (at & 63) & 1).astype(bool)
