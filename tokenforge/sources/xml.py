"""XML records."""

from __future__ import annotations

import xml.sax
import xml.sax.saxutils
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_xml(spark: SparkSession, path: str, tag: str = "record", schema: str | None = None, missing: str = "error") -> DataFrame:
    """The child elements of every ``tag`` element as columns; attributes are dropped, and so are empty records."""
    reader = spark.read.format("xml").option("rowTag", tag).option("ignoreSurroundingSpaces", "true").option("excludeAttribute", "true").option("recursiveFileLookup", "true")
    try:
        df = (reader.schema(schema) if schema else reader.option("inferSchema", "false")).load(path)
    except AnalysisException as e:
        if missing != "empty" or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema or T.StructType([]))
    if not df.columns:
        return df
    some = F.lit(False)
    for c in df.columns:
        some = some | F.col(f"`{c}`").isNotNull()
    return df.where(some)


class _Plain(xml.sax.ContentHandler):
    """Writes elements without attributes, comments and white space around text."""

    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []
        self.text: list[str] = []

    def _flush(self) -> None:
        text = "".join(self.text).strip()
        if text:
            self.out.append(xml.sax.saxutils.escape(text))
        self.text = []

    def startElement(self, name, attrs) -> None:  # noqa: N802
        self._flush()
        self.out.append(f"<{name}>")

    def endElement(self, name) -> None:  # noqa: N802
        self._flush()
        self.out.append(f"</{name}>")

    def characters(self, content) -> None:
        self.text.append(content)


def _plain(raw: str) -> str | None:
    handler = _Plain()
    try:
        xml.sax.parseString(raw.encode(), handler)
    except xml.sax.SAXException:
        return None
    return "".join(handler.out)


@F.pandas_udf(T.StringType())
def plain_xml(records: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Records as XML text without attributes, comments and instructions; NULL where a record is malformed."""
    for s in records:
        yield s.map(_plain, na_action="ignore")


def record_texts(document: Column, tag: str = "record") -> Column:
    """The texts of the outermost ``tag`` elements of an XML document, as an array; self-closed ones are left out."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(documents: pd.Series) -> pd.Series:
        import re

        mark = re.compile(rf"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(/?){re.escape(tag)}(?=[\s/>])[^>]*?(/?)>", re.S)

        def one(text: str) -> list[str]:
            out, depth, start = [], 0, 0
            for m in mark.finditer(text):
                if m[1] is None:
                    continue
                if m[1]:
                    depth -= 1
                    if depth == 0:
                        out.append(text[start : m.end()])
                elif not m[2]:
                    if depth == 0:
                        start = m.start()
                    depth += 1
            return out

        return documents.map(one, na_action="ignore")

    return cut(document)


def read_xml_texts(spark: SparkSession, path: str, tag: str = "record", missing: str = "error") -> DataFrame:
    """``content``: each outermost ``tag`` element as XML text; malformed ones are left out.  A task holds one file at a time."""
    try:
        files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    except AnalysisException as e:
        if missing != "empty" or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "content string")
    records = files.select(F.explode(record_texts(F.col("value"), tag)).alias("raw"))
    return records.select(plain_xml("raw").alias("content")).where("content is not null")
