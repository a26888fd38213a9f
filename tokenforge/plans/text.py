"""Natural-language pipelines: text to tokens and byte counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..endpoints import Debug, Endpoint, Lines, TokenFile, TokenUnit
from ..functions import bpe, text
from ..functions.json import strict_text, u16_tokens
from ..functions.json import tokens_text as as_text
from ..operators.bag import byte_histogram, first_rows
from ..operators.pipeline import REFUSED, Metrics, run, split
from ..sinks.files import write_histogram
from ..sources.lines import read_lines
from ..storage import spread


def flagged_texts(lines: DataFrame) -> DataFrame:
    """``text`` of good JSON lines, and refused lines as they are."""
    parsed = spread(lines.select("content")).select("content", strict_text("content").alias("text"))
    return parsed.select("text", F.when(F.col("text").isNull(), F.coalesce("content", F.lit(""))).alias(REFUSED))


def texts(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``text`` of good JSON lines, refused lines)."""
    return split(flagged_texts(lines))


def jsonl_to_tokens(spark: SparkSession, source: Lines, vocabulary: bpe.Vocabulary, outputs: list[Endpoint], rejects: Endpoint | None = None) -> Metrics:
    """JSON lines to longest-match tokens with an end token, into 16-bit token files."""
    encode = bpe.encoder(spark, vocabulary)
    return run(spark, [source], lambda lines: flagged_texts(lines).select(encode("text").alias("tokens"), REFUSED), outputs, rejects=rejects)


def jsonl_to_bytes(spark: SparkSession, source: Lines, outputs: list[Endpoint], rejects: Endpoint | None = None) -> Metrics:
    """JSON lines to UTF-8 bytes with an end-of-document byte, into 8-bit token files."""
    ended = text.utf8(text.with_end(F.col("text"))).alias("tokens")
    return run(spark, [source], lambda lines: flagged_texts(lines).select(ended, REFUSED), outputs, rejects=rejects)


def tokens_to_debug(spark: SparkSession, source: TokenFile, sink: Debug, n: int = 5) -> Metrics:
    """The first lines of a token file, as checked JSON arrays, to a debug sink."""

    def transform(lines: DataFrame) -> tuple[DataFrame, None]:
        return first_rows(lines.select(u16_tokens(as_text(F.col("tokens"))).alias("tokens")).where("tokens is not null"), n), None

    return run(spark, [source], transform, [sink])


def jsonl_to_histogram(spark: SparkSession, source: Lines, path: str) -> DataFrame:
    """The byte histogram of JSON lines, written as CSV of 256 rows."""
    good, _ = texts(read_lines(spark, source.path, source.limit))
    counts = byte_histogram(spark, good)
    write_histogram(counts, path)
    return counts


#: The production settings of the sinks.
TEXT_TOKENS = {"unit": TokenUnit.U16, "context_length": 128}
BYTE_TOKENS = {"unit": TokenUnit.U8, "context_length": 4096}
