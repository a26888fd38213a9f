"""The same pipelines over streams: stateless transformations, keyed upserts and running byte counts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .. import endpoints as E
from ..operators.keyed import KeyedStore
from ..operators.pipeline import Transform, sink, split


def stream_lines(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """``content`` of the lines of files that appear in ``folder``."""
    lines = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_a_batch).text(folder)
    return lines.select(F.regexp_replace("value", "\r$", "").alias("content"))


def stream_to(df: DataFrame, transform: Transform, outputs: list[E.Endpoint], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Send each micro-batch through ``transform`` to every output.

    Each batch has its own files: ``<filename>_<number>`` of token files, the folder ``batch=<number>`` of text, FASTA and
    XML.  A batch that runs again replaces its own files and sets the same keys; a JDBC table gets its rows again.
    """

    def batch(rows: DataFrame, number: int) -> None:
        good, _ = split(transform(rows))
        for spec in outputs:
            match spec:
                case E.TokenFile():
                    spec = replace(spec, filename=f"{spec.filename}_{number}")
                case E.Lines() | E.Fasta() | E.Xml():
                    spec = replace(spec, path=f"{spec.path.rstrip('/')}/batch={number}")
            sink(good, spec)

    writer = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_upserts(rows: DataFrame, store: KeyedStore, db: int, checkpoint: str) -> StreamingQuery:
    """Upsert a stream of ``(key, value, seq)`` rows."""
    return rows.writeStream.foreachBatch(lambda b, _: store.write(b, db, "seq")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, width: str, late: str, key: str) -> DataFrame:
    """Counts of ``key`` by tumbling window of event time; rows later than ``late`` are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("start"), key, "n"
    )


