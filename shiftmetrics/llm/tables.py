"""Sums of large count tables over all tasks: the tables' size is fixed, whatever the corpus."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Counts of one chunk, in which tables travel.
CHUNK = 1 << 14


def packed_chunks(table: np.ndarray, first: int = 0) -> pa.RecordBatch:
    """A table of counts as rows (chunk, counts), in a larger table from place ``first`` on (a multiple of CHUNK);
    chunks of zeros are left out."""
    width, some, blobs = "<u4" if table.max(initial=0) < 1 << 32 else "<i8", [], []
    for at in range(0, len(table), CHUNK):
        counts = table[at:at + CHUNK]
        if counts.any():
            some.append((first + at) // CHUNK)
            # All low bytes first: the high ones are nearly all zero.
            wide = np.pad(counts, (0, CHUNK - len(counts))).astype(width)
            blobs.append(width.encode() + zlib.compress(wide.view(np.uint8).reshape(CHUNK, -1).T.tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "counts"])


def total_table(parts: DataFrame, size: int, kind: type = np.int64) -> np.ndarray:
    """The sum of tables of ``size`` counts, from rows of ``packed_chunks``; in a narrower ``kind`` counts stop at half its range,
    so that two tables can be added."""
    def summed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in rows:
            for chunk, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bytewise = np.frombuffer(zlib.decompress(blob[3:]), np.uint8).reshape(-1, CHUNK)
                counts = np.ascontiguousarray(bytewise.T).view(blob[:3].decode()).reshape(-1).astype(np.int64)
                total[chunk] = total[chunk] + counts if chunk in total else counts
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())], ["chunk", "counts"])

    table = np.zeros((-(-size // CHUNK), CHUNK), kind)
    for r in parts.repartition("chunk").mapInArrow(summed, "chunk int, counts binary").collect():
        table[r["chunk"]] = np.minimum(np.frombuffer(zlib.decompress(r["counts"]), np.int64), np.iinfo(kind).max // 2)
    return table.reshape(-1)[:size]
