"""Counts of 64-bit keys over a whole corpus in a table of fixed size.

Each key counts in one of BUCKETS buckets. A bucket's total is at least the
count of any key in it, whatever the size of the corpus; what is built on it
stays exact where an upper bound, or just the same order everywhere, is enough.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices, small_batches, text_bytes

BITS = 18
BUCKETS = 1 << BITS
#: Tasks of which one group of the first level takes the counts, and buckets of a row.
FAN, BLOCK = 256, 8192


def bucket(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS)).astype(np.int64)


def _task(batches, keys_of):
    total = np.zeros(BUCKETS, np.int64)
    rows = 0
    for batch in batches:
        rows += batch.num_rows
        for part in slices(batch):
            total += np.bincount(bucket(keys_of(*text_bytes(part.column("text")))), minlength=BUCKETS)
    blocks = [i for i in range(BUCKETS // BLOCK) if total[i * BLOCK : (i + 1) * BLOCK].any()]
    task = TaskContext.get().partitionId() // FAN
    counts = [total[i * BLOCK : (i + 1) * BLOCK].tobytes() for i in blocks]
    yield pa.RecordBatch.from_arrays([pa.array([task] * (len(blocks) + 1), pa.int64()), pa.array([*blocks, -1], pa.int64()), pa.array([*counts, np.int64(rows).tobytes()], pa.binary())], names=["task", "block", "counts"])


def _add(df: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in df["counts"])
    return pd.DataFrame({"task": [df["task"].iloc[0]], "block": [df["block"].iloc[0]], "counts": [total.tobytes()]})


def count(docs: DataFrame, keys_of, name: str) -> tuple[np.ndarray, int]:
    """Bucket totals of the keys that keys_of(bytes, offsets) gives for the texts, and the number of rows.

    Tasks add up their own counts; then groups of FAN tasks, then all are added,
    by block of buckets. The driver gets BUCKETS numbers.
    """
    small_batches(docs.sparkSession)
    schema = "task bigint, block bigint, counts binary"
    parts = docs.select("text").mapInArrow(lambda batches: _task(batches, keys_of), schema)
    for level in (["task", "block"], ["block"]):
        parts = parts.groupBy(*level).applyInPandas(_add, schema)
    out, rows = np.zeros(BUCKETS, np.int64), 0
    for r in saved(parts.select("block", "counts"), name).collect():
        if r["block"] < 0:
            rows = int(np.frombuffer(r["counts"], np.int64)[0])
        else:
            out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.int64)
    return out, rows
