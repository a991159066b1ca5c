"""A filter of one bit for each place that a wanted key has by its hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 2 to this power.
FILTER = 26
TURN = 0xD1342543DE82EF95


def _place(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(TURN)) >> np.uint64(64 - FILTER)


def bits_of(wanted: DataFrame) -> np.ndarray:
    """The filter of ``wanted``, a frame of one column of longs."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _place(batch.column(0).to_numpy().view(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(1 << (at & 31))], names=["at", "bit"])
    rows = wanted.mapInArrow(places, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER - 5), np.uint32)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits


def may(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be a wanted one."""
    at = _place(keys)
    return (bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
