"""FASTA and FASTQ records."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.text import header_description, header_id

_EMPTY = "id string, desc string, seq string"


def _first_byte(spark: SparkSession, uri: str) -> int:
    """The first byte of a file, after unpacking where its name asks for it; -1 of an empty one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        return (codec.createInputStream(stream) if codec is not None else stream).read()
    finally:
        stream.close()


def _without_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``(value, file, start)`` without the first row of each file."""
    last = None
    for b in batches:
        keep = np.ones(b.num_rows, bool)
        for i, (file, start) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
            if (file, start) != last:
                last = (file, start)
                keep[i] = start != 0
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep))], names=["value"])


def read_fasta(spark: SparkSession, path: str, missing: str = "error") -> DataFrame:
    """``(id, desc, seq)`` of the records of ``path``, which may be a glob.

    Records are split at line ends before ``>``, by the JVM's splittable line reader.  Sequence lines are joined; text
    before the first record is left out: the driver looks at the first byte of each file, and files that do not begin with
    a record lose what is before it in Python tasks of their own.
    """
    try:
        raw = spark.read.text(path, lineSep="\n>")
    except AnalysisException as e:
        if missing != "empty" or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _EMPTY)
    files = raw.inputFiles()
    with ThreadPoolExecutor(16) as pool:
        firsts = list(pool.map(lambda f: _first_byte(spark, f), files))
    odd = [f for f, x in zip(files, firsts, strict=True) if x not in (ord(">"), -1)]
    rows = raw.select("value")
    if odd:
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        # as the column of metadata has them
        shown = [path_of(path_of(spark._jvm.java.net.URI(f)).toString()).toUri().toString() for f in odd]
        cut = raw.where(F.col("_metadata.file_path").isin(shown)).select("value", "_metadata.file_path", "_metadata.file_block_start")
        rows = raw.where(~F.col("_metadata.file_path").isin(shown)).select("value").unionByName(cut.mapInArrow(_without_firsts, "value string"))
    # the first record of a file keeps its mark
    text = F.regexp_replace("value", "^>", "")
    header = F.regexp_replace(F.substring_index(text, "\n", 1), "\r$", "")
    body = F.when(F.contains(text, F.lit("\n")), F.regexp_replace(F.regexp_replace(text, r"(?s)^[^\n]*\n", ""), "[\r\n]", "")).otherwise("")
    return rows.where(text != "").select(header_id(header).alias("id"), header_description(header).alias("desc"), body.alias("seq"))


def read_fastq(spark: SparkSession, path: str, missing: str = "error") -> DataFrame:
    """``(id, desc, seq)`` of four-line records; qualities are dropped.

    Lines are numbered in file order from the counts of lines in each split: a small table of splits is windowed, and
    only headers and sequences are shuffled, by record.
    """
    try:
        raw = spark.read.text(path, lineSep="\n")
    except AnalysisException as e:
        if missing != "empty" or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _EMPTY)
    lines = raw.select(
        F.regexp_replace("value", "\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    splits = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("place") - F.col("first")
    placed = lines.join(before, ["file", "start"]).select("file", "line", F.floor(number / 4).alias("record"), (number % 4).alias("k"))
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("line")))
    records = placed.where("k < 2").groupBy("file", "record").agg(pick(0).alias("head"), pick(1).alias("seq"))
    head = F.substr("head", F.lit(2))
    return records.where(F.startswith("head", F.lit("@"))).select(
        header_id(head).alias("id"), header_description(head).alias("desc"), F.coalesce("seq", F.lit("")).alias("seq")
    )
