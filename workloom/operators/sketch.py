"""How often values occur, as a count-min sketch of fixed size: it orders values by rarity, whatever their number."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters of one row of the sketch; it has two.
COUNTERS = 1 << 20
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x + _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


def slots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counter of each value in either row."""
    m = mix(values.view(np.uint64))
    return (m % np.uint64(COUNTERS)).astype(np.int64), ((m >> np.uint64(32)) % np.uint64(COUNTERS)).astype(np.int64) + COUNTERS


def estimate(sketch: np.ndarray, values: np.ndarray) -> np.ndarray:
    """At least as often as each value occurs."""
    a, b = slots(values)
    return np.minimum(sketch[a], sketch[b]).astype(np.int64)


def frequencies(df: DataFrame, column: str) -> np.ndarray:
    """The sketch of the bigints in an array column: each partition counts into its own, Spark sums these up, and only
    2 * COUNTERS numbers come to the driver, however many values there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * COUNTERS, dtype=np.int64)
        for batch in batches:
            for part in slots(batch.column(0).flatten().to_numpy(zero_copy_only=False)):
                total += np.bincount(part, minlength=2 * COUNTERS)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 18):
            some = at[i : i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["slot", "n"])

    sums = df.select(column).mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * COUNTERS, dtype=np.int32)
    out[sums["slot"].to_numpy()] = np.minimum(sums["n"].to_numpy(), 2**31 - 1)
    return out
