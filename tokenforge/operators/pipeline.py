"""The pipeline runner: sources to one bag, a transformation, and all sinks."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import endpoints as E
from ..errors import UnsupportedEndpointError
from ..functions.text import display_pair
from ..sinks.files import debug, write_fasta, write_lines, write_xml
from ..sinks.jdbc import write_jdbc
from ..sources.fasta import read_fasta, read_fastq
from ..sources.jdbc import read_jdbc
from ..sources.lines import read_lines
from ..sources.tokenfile import read_tokens, write_tokens
from ..sources.xml import read_xml, read_xml_texts
from ..storage import dropped, stored
from .bag import union
from .keyed import KeyedStore, scan


@dataclass
class Metrics:
    """What a run counted."""

    read: int = 0
    sent: int = 0
    rejected: int = 0
    seconds: float = 0.0
    primes: list[int] = field(default_factory=list)

    @property
    def rate(self) -> float:
        return self.read / self.seconds if self.seconds else 0.0


def source(spark: SparkSession, spec: E.Endpoint, missing: str = "error") -> DataFrame:
    """The rows of an endpoint.  ``missing="empty"``: what does not exist has no rows; else it is an error."""
    match spec:
        case E.Lines():
            return read_lines(spark, spec.path, spec.limit, missing)
        case E.Fasta():
            return read_fasta(spark, spec.path, missing)
        case E.Xml():
            if spec.as_text:
                return read_xml_texts(spark, spec.path, spec.record_tag, missing)
            return read_xml(spark, spec.path, spec.record_tag, missing=missing)
        case E.Fastq():
            return read_fastq(spark, spec.path, missing)
        case E.Jdbc():
            return read_jdbc(spark, spec, missing)
        case E.KeyValue():
            return scan(KeyedStore(spark, spec.path).read(spec.db, missing), spec.prefix)
        case E.TokenFile():
            return read_tokens(spark, spec.files, spec.unit, spec.units_per_token, missing)
    raise UnsupportedEndpointError(f"{type(spec).__name__} is no source")


def sink(df: DataFrame, spec: E.Endpoint) -> int | None:
    """Write the rows of ``df`` to an endpoint."""
    match spec:
        case E.Debug():
            debug(df, spec.prefix or "")
        case E.Lines():
            pair = {"key", "value"} <= set(df.columns)
            write_lines(df, display_pair(F.col("key"), F.col("value")) if pair else F.col(df.columns[0]).cast("string"), spec.path)
        case E.Fasta():
            write_fasta(df, spec.path)
        case E.Xml():
            write_xml(df, spec.path, spec.record_tag)
        case E.Jdbc():
            write_jdbc(df, spec)
        case E.KeyValue():
            KeyedStore(df.sparkSession, spec.path).write(df, spec.db, "seq" if "seq" in df.columns else None)
        case E.TokenFile():
            return write_tokens(df, spec)
        case _:
            raise UnsupportedEndpointError(f"{type(spec).__name__} is no sink")
    return None


#: The column of a flagged frame that says what was refused, NULL in rows to send.
REFUSED = "refused"
#: A transformation returns one flagged frame, or the rows to send and the rows it refuses.
Transform = Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame | None]]


def split(result: DataFrame | tuple[DataFrame, DataFrame | None]) -> tuple[DataFrame, DataFrame | None]:
    """(rows to send, refused rows) of what a transformation returns."""
    if isinstance(result, tuple):
        return result
    return result.where(F.col(REFUSED).isNull()).drop(REFUSED), result.where(F.col(REFUSED).isNotNull()).select(REFUSED)


def run(
    spark: SparkSession,
    inputs: list[E.Endpoint],
    transform: Transform,
    outputs: list[E.Endpoint],
    missing: str = "error",
    finish: Callable[[DataFrame], DataFrame] | None = None,
    rejects: E.Endpoint | None = None,
) -> Metrics:
    """Union the sources, transform, and write to every sink.

    Without inputs nothing happens; without outputs the inputs are counted and not transformed.  Transformed rows are
    stored once and read by each sink; ``finish`` (a numbering, say, that reads its input more than once) is applied to
    the stored rows.  Refused rows go to ``rejects`` where one is given.  A flagged frame is computed in one pass over the
    sources, a pair of frames in one pass each.
    """
    out, began = Metrics(), time.monotonic()
    if not inputs:
        return out
    bag = union([source(spark, x, missing) for x in inputs])
    if not outputs:
        out.read = bag.count()
        out.seconds = time.monotonic() - began
        return out
    reading = Observation()
    result = transform(bag.observe(reading, F.count(F.lit(1)).alias("n")))
    paths = []

    def kept(df: DataFrame) -> DataFrame:
        df, path = stored(df, "pipeline")
        paths.append(path)
        return df

    try:
        if isinstance(result, tuple):
            good, bad = kept(result[0]), result[1]
            out.read = reading.get["n"]
            bad = kept(bad) if bad is not None else None
        else:
            good, bad = split(kept(result))
            out.read = reading.get["n"]
        out.sent = good.count()
        if bad is not None:
            out.rejected = bad.count()
            if rejects is not None:
                sink(bad, rejects)
        if finish is not None:
            good = finish(good)
        for spec in outputs:
            prime = sink(good, spec)
            if prime is not None:
                out.primes.append(prime)
    finally:
        for path in paths:
            dropped(spark, path)
    out.seconds = time.monotonic() - began
    return out


def chain(steps: list[Callable[[], Metrics]], together: bool = False) -> list[Metrics]:
    """Run pipelines one after the other, or together from threads of the driver."""
    if not together:
        return [s() for s in steps]
    with ThreadPoolExecutor(len(steps) or 1) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]
