"""Bag operators: union, weighted mixture, first rows, byte histogram."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import NoComponentError
from ..functions.text import END
from ..storage import unused


def union(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, repeated ones too."""
    if not frames:
        raise NoComponentError("a union of nothing")
    return reduce(DataFrame.unionByName, frames)


def mixture(parts: list[tuple[DataFrame, int]]) -> DataFrame:
    """Each frame's rows as often as its weight says; a frame is scanned once."""


    def repeated(df: DataFrame, k: int) -> DataFrame:
        copy = unused(df, "_copy")
        return df.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(k)))).drop(copy)

    return union([df if k == 1 else repeated(df, k) for df, k in parts if k > 0])


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The feature is a limit: any ``n`` rows."""
    return df.limit(n)


def byte_histogram(spark: SparkSession, texts: DataFrame, column: str = "text", end: str = END) -> DataFrame:
    """``(byte, count)`` for all 256 bytes of the UTF-8 texts, each with ``end`` after it.  NULL texts are left out.

    A task counts its batches with one histogram each, so 256 sums a task are shuffled.
    """
    tail = np.bincount(np.frombuffer(end.encode(), np.uint8), minlength=256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for b in batches:
            texts = pc.drop_null(b.column(0).cast(pa.large_string()))
            _, offsets, data = texts.buffers()
            total += tail * len(texts)
            if len(texts) and data is not None:
                off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
                for lo in range(off[0], off[-1], 1 << 24):
                    total += np.bincount(np.frombuffer(data, np.uint8)[lo : min(lo + (1 << 24), off[-1])], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(total)], names=["byte", "count"])

    counts = texts.select(column).mapInArrow(run, "byte int, count long")
    every = spark.range(256).select(F.col("id").cast("int").alias("byte"), F.lit(0).cast("long").alias("count"))
    return counts.unionByName(every).groupBy("byte").agg(F.sum("count").alias("count"))
