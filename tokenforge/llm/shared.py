"""Components and grouping helpers of the llm operators, beside the library's shared storage."""

from __future__ import annotations

import ctypes
import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import dropped, fresh_path, shared_dir, spread, stored, table, unused
from .textkit import mix

#: Bits of a filter at most: 256 MB, enough for 180 million values at 12 bits each.  Beyond it more rows pass, and none is lost.
MOST_BITS = 1 << 31
#: So few edges are taken by one task: a few MB.  More are contracted by rounds first.
FEW_EDGES = 1 << 18

__all__ = ["Filter", "components", "dropped", "fresh_path", "lean", "made_filter", "shared_dir", "spread", "stored", "table", "unused", "whole_groups"]


def _least(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, of ``n`` nodes and the edges between ``u`` and ``v``."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != (label := label[label])).any():
            pass


def _all_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, t): the smallest node of each one's component, where ``batches`` are all edges."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    e = pa.Table.from_batches(held)
    ends = [e.column(c).combine_chunks() for c in ("u", "v")]
    nodes = pc.unique(pa.chunked_array(ends))
    nodes = nodes.take(pc.array_sort_indices(nodes))
    u, v = (pc.index_in(x, nodes).to_numpy() for x in ends)
    label = _least(len(nodes), u, v)
    for k in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([nodes[k : k + (1 << 16)], nodes.take(pa.array(label[k : k + (1 << 16)]))], names=["u", "t"])


def _plain(kind: T.DataType) -> bool:
    """Whether Arrow orders the type as Spark does."""
    return kind in (T.LongType(), T.IntegerType(), T.BinaryType(), T.StringType())


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of ``edges(src, dst)`` as ``(id, component)`` with the smallest id of each component.

    Ids may be of any type with an order.

    Every node points at the neighbour (or itself) that comes first in a hashed order; edges are rewritten to
    those targets and the loops fall away, until no edge is left.  The hashed order contracts long paths by a
    constant factor a round, a star in one.  All steps are joins and partially aggregated groupings; rounds are
    cut by tables in the shared folder.  Once FEW_EDGES or fewer are left (of ids that are integers, strings or binary), one
    task joins them all, as plans and jobs of the last rounds cost the driver far more than their rows.  Null ends and
    loops are ignored; no edges give an empty table.
    """
    spark = edges.sparkSession
    e, path = stored(
        edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct(),
        name,
    )
    labels = lpath = None
    plain = _plain(e.schema["u"].dataType)
    while n := e.count():
        if plain and n <= FEW_EDGES:
            kind = e.schema["u"].dataType.simpleString()
            last = e.coalesce(1).mapInArrow(_all_joined, f"u {kind}, t {kind}")
            if labels is None:
                return last.select(F.col("u").alias("id"), F.col("t").alias("component"))
            labels = labels.join(last, F.col("root") == F.col("u"), "left").select("id", F.coalesce("t", "root").alias("root"))
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("i"))
        point, ppath = stored(
            both.groupBy("u").agg(F.min(key("v")).alias("m")).select("u", F.least(key("u"), F.col("m"))["i"].alias("t")),
            name,
        )
        to = lambda c, t: point.select(F.col("u").alias(c), F.col("t").alias(t))
        if labels is None:
            labels2 = point.select(F.col("u").alias("id"), F.col("t").alias("root"))
        else:
            labels2 = labels.join(to("root", "t"), "root", "left").select("id", F.coalesce("t", "root").alias("root"))
        labels2, lpath2 = stored(labels2, name)
        e2, path2 = stored(
            e.join(to("u", "tu"), "u")
            .join(to("v", "tv"), "v")
            .where("tu <> tv")
            .select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v"))
            .distinct(),
            name,
        )
        for old in filter(None, (path, ppath, lpath)):
            dropped(spark, old)
        e, path, labels, lpath = e2, path2, labels2, lpath2
    if labels is None:
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    least = labels.groupBy("root").agg(F.min("id").alias("component"))
    return labels.join(least, "root").select("id", "component")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most_rows: int | None = None) -> Iterator[pa.Table]:
    """From batches sorted by ``keys``, tables that hold whole key groups (several groups each)."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = tuple(b.column(k)[b.num_rows - 1].as_py() for k in keys)
        # first row of the last, perhaps unfinished, group
        lo, hi = 0, b.num_rows - 1
        while lo < hi:
            mid = (lo + hi) // 2
            if tuple(b.column(k)[mid].as_py() for k in keys) == last:
                hi = mid
            else:
                lo = mid + 1
        if lo == 0 and held and tuple(held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys) == last:
            held.append(b)
            continue
        done = held + ([b.slice(0, lo)] if lo else [])
        if done:
            yield pa.Table.from_batches(done)
        held = [b.slice(lo)]
    if held:
        yield pa.Table.from_batches(held)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the process gives the memory it has freed back to the system.

    A worker waits for its next task with all that its allocators have kept, and tasks take waiting workers in turn, so else
    each worker of an executor would come to hold the most that any task has needed.
    """

    @functools.wraps(run)
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim is not None:
                trim(0)

    return held


class Filter:
    """A Bloom filter of 64-bit values.  Its size is bounded whatever their number; a full one lets more through."""

    def __init__(self, count: int) -> None:
        self.bits = min(MOST_BITS, 1 << max(16, (count * 12).bit_length()))
        self.packed = np.zeros(self.bits // 8, np.uint8)

    def places(self, x: np.ndarray) -> list[np.ndarray]:
        h = mix(x.view(np.uint64) + np.uint64(0x1F83D9AB))
        return [((h >> np.uint64(s)) & np.uint64(self.bits - 1)).astype(np.int64) for s in (0, 17, 34)]

    def add(self, x: np.ndarray) -> None:
        for at in self.places(x):
            np.bitwise_or.at(self.packed, at >> 3, (128 >> (at & 7)).astype(np.uint8))

    def has(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for at in self.places(x):
            out &= (self.packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return out


#: Parts of a filter, each a row of its own while it is joined.
_PARTS = 64


def made_filter(values: DataFrame, column: str, count: int) -> Filter:
    """The filter of a column of longs, built by all tasks.

    Tasks give the parts of their filters that have bits; rows of one part are joined by other tasks, and
    the driver lays at most _PARTS rows side by side.
    """
    out = Filter(count)
    size = len(out.packed) // _PARTS
    schema = pa.schema([("part", pa.int32()), ("f", pa.binary())])

    def given(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, x in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, some = Filter(count), False
        for b in batches:
            some |= b.num_rows > 0
            own.add(b.column(0).to_numpy(zero_copy_only=False))
        if some:
            yield from given({k: x for k, x in enumerate(own.packed.reshape(_PARTS, size)) if x.any()})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("part").to_pylist(), b.column("f").to_pylist(), strict=True):
                raw = np.frombuffer(zlib.decompress(x), np.uint8)
                if k in parts:
                    parts[k] |= raw
                else:
                    parts[k] = raw.copy()
        yield from given(parts)

    rows = values.select(column).mapInArrow(run, "part int, f binary").repartition("part").mapInArrow(joined, "part int, f binary")
    for r in rows.toLocalIterator():
        out.packed[r["part"] * size : (r["part"] + 1) * size] |= np.frombuffer(zlib.decompress(r["f"]), np.uint8)
    return out
