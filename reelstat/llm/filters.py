"""Bloom filters of a fixed size, built by Spark: they prune what cannot matter, and what they let through is settled exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.shingles import mix

FILTER_LONGS = 1 << 19  # 4 MB: 4 of 32 million bits per entry; a fuller filter prunes less and changes no result
PROBES = 4


class Filter:
    """A Bloom filter: a fixed table of bits that holds all entries and, by mistake, some others."""

    def __init__(self, longs: np.ndarray):
        self.bits = longs.view(np.uint64)

    @staticmethod
    def places(numbers: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(FILTER_LONGS * 64)
        return [mix(numbers + np.uint64(k)) % size for k in range(1, PROBES + 1)]

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        found = np.ones(len(numbers), bool)
        for place in self.places(numbers):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def build_filter(numbers: DataFrame) -> np.ndarray:
    """The bits of a filter of all ``number``s, or-ed together by Spark; ``FILTER_LONGS`` rows at most reach the driver."""
    schema = pa.schema([("slot", pa.int32()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(Filter.places(batch.column(0).to_numpy().view(np.uint64)))
            slots, back = np.unique(place >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(bits, back, np.uint64(1) << (place & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(bits.view(np.int64))], schema=schema)

    found = numbers.mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(FILTER_LONGS, np.int64)
    table[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return table
