"""Line files: JSON lines, TSV and plain text are read alike, one row a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def read_lines(spark: SparkSession, path: str, limit: int | None = None, missing: str = "error") -> DataFrame:
    """``content`` of every line of ``path`` (a glob may match several files), in blank lines too.

    Lines end at a line feed, a carriage return before it falls off.  ``limit``: the first lines in file order.
    ``missing="empty"`` reads a path that does not exist as no lines.
    """
    try:
        lines = spark.read.text(path, lineSep="\n")
    except AnalysisException as e:
        if missing != "empty" or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "content string")
    content = F.regexp_replace("value", "\r$", "").alias("content")
    if limit is None:
        return lines.select(content)
    placed = lines.select(content, "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    return placed.orderBy("file_path", "file_block_start", "place").limit(limit).select("content")
