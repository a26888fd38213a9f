"""Keyed tables: (db, key, value, seq) rows with unique keys in each database."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ComponentError
from ..storage import unused

SCHEMA = "db int, key string, value string, seq long"


def scan(kv: DataFrame, prefix: str = "", db: int | None = None) -> DataFrame:
    """``(key, value)`` of the keys that start with ``prefix``, taken literally; pushed down to the table's files."""
    rows = kv if db is None else kv.where(F.col("db") == db)
    if prefix:
        rows = rows.where(F.startswith("key", F.lit(prefix)))
    return rows.select("key", "value")


def lookup(left: DataFrame, left_key: Column, kv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with their ``value``, misses): an inner join on the key, which is unique on the right, and what it leaves.

    The planner broadcasts the keyed side only where its size is known to be small.
    """
    name = unused(left, "_key")
    keyed = left.withColumn(name, left_key)
    right = kv.select(F.col("key").alias(name), "value")
    return keyed.join(right, name).drop(name), keyed.join(right, name, "left_anti").drop(name)


def upsert(rows: DataFrame, order: str | Column = "seq") -> DataFrame:
    """One row for each key: the value of the greatest ``order``.  Partial aggregates go before the shuffle."""
    return rows.groupBy("key").agg(F.max_by("value", order).alias("value"))


class KeyedStore:
    """Keyed tables in Parquet: segments that are appended and, once there are several, laid together.

    A write costs its own rows only.  It is staged beside the segments and appears by one rename, so readers see all of
    it or nothing and a write that fails changes nothing.  A segment ``s-<first>-<last>`` holds one row a key of the writes
    ``first`` to ``last``; of equal keys the last write's value counts.  Once ``SEGMENTS`` writes are apart they are laid together
    in one segment; those it replaces stay until the next time, for readers that began before.  One writer a database.
    """

    #: Segments that are read side by side before they are laid together.
    SEGMENTS = 8

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, db: int):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/db={db}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _segments(self, db: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """(segments to read, by age; replaced segments)."""
        fs, p = self._at(db)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        found = sorted((int(m[1]), int(m[2])) for m in (re.fullmatch(r"s-(\d+)-(\d+)", n) for n in names) if m)
        live = [x for x in found if not any(o != x and o[0] <= x[0] and x[1] <= o[1] for o in found)]
        return live, [x for x in found if x not in live]

    def _segment(self, db: int, first: int, last: int) -> str:
        return f"{self.path}/db={db}/s-{first:09d}-{last:09d}"

    def _merged(self, db: int, segments: list[tuple[int, int]]) -> DataFrame:
        parts = [
            self.spark.read.schema("key string, value string").parquet(self._segment(db, *s)).withColumn("seq", F.lit(s[1])) for s in segments
        ]
        if len(parts) == 1:
            return parts[0].drop("seq")
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return upsert(rows)

    def read(self, db: int, missing: str = "empty") -> DataFrame:
        """``(key, value)`` of a database; a database that was never written is empty, or an error."""
        live, _ = self._segments(db)
        if live:
            return self._merged(db, live)
        if missing != "empty":
            raise ComponentError(f"{self.path} has no database {db}")
        return self.spark.createDataFrame([], "key string, value string")

    def _publish(self, db: int, rows: DataFrame, first: int, last: int) -> None:
        fs, p = self._at(db)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        staged = f"{self.path}/db={db}/_staged-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(staged)
            if not fs.rename(path(staged), path(self._segment(db, first, last))):
                raise ComponentError(f"{self._segment(db, first, last)} is there already")
        finally:
            fs.delete(path(staged), True)

    def write(self, rows: DataFrame, db: int, order: str | None = None) -> None:
        """Set the keys of ``rows(key, value)``.  Of equal keys the greatest ``order`` wins, else any one."""
        place = F.col(order) if order else F.monotonically_increasing_id()
        live, _ = self._segments(db)
        number = live[-1][1] + 1 if live else 0
        self._publish(db, upsert(rows.select("key", "value", place.cast("long").alias("seq"))), number, number)
        if len(live) + 1 > self.SEGMENTS:
            self.compact(db)

    def compact(self, db: int) -> None:
        """Lay all segments together, and delete those that the last such call replaced."""
        live, old = self._segments(db)
        if len(live) > 1:
            fs, _ = self._at(db)
            self._publish(db, self._merged(db, live), live[0][0], live[-1][1])
            for s in old:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._segment(db, *s)), True)


def next_id(prefix: str, column: str = "key") -> Column:
    """An aggregate: one more than the greatest number after ``prefix``, or 0."""
    from ..functions.text import key_number

    return F.coalesce(F.max(key_number(F.col(column), prefix)) + 1, F.lit(0)).alias("next_id")
