"""Text, FASTA, XML, CSV and debug sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fasta_record


def write_lines(df: DataFrame, line: Column, path: str, one_file: bool = False) -> None:
    """One line a row.  ``one_file`` keeps the contract of a single file, through one task."""
    lines = df.select(line.alias("value"))
    (lines.coalesce(1) if one_file else lines).write.mode("overwrite").text(path)


def write_fasta(df: DataFrame, path: str, width: int = 70) -> None:
    """``df(id, desc, seq)`` as FASTA records wrapped at ``width``."""
    write_lines(df, fasta_record(F.col("id"), F.col("desc"), F.col("seq"), width), path)


def write_xml(df: DataFrame, path: str, tag: str = "record", root: str = "records") -> None:
    df.write.mode("overwrite").format("xml").option("rowTag", tag).option("rootTag", root).save(path)


def write_histogram(counts: DataFrame, path: str) -> None:
    """``byte,count`` lines for 0 to 255, without a header, in one file (256 rows)."""
    counts.coalesce(1).sortWithinPartitions("byte").select("byte", "count").write.mode("overwrite").csv(path, header=False)


def debug(df: DataFrame, prefix: str = "", show: int = 0) -> int:
    """Count the rows, and show some where asked to."""
    n = df.count()
    if show:
        df.show(show, truncate=False)
    print(f"{prefix}{n} items")
    return n
