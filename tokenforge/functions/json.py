"""JSON expressions: strict and loose parsing, access, type tests and construction."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .slices import slices


def allow_duplicate_keys(spark: SparkSession) -> None:
    """Let the last of equal keys win in untyped parsing, as JSON libraries do."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


class _Object(list):
    """The pairs of a JSON object."""


class _Number(str):
    """A number as it is written: of any length, and told apart from texts."""


#: Escapes of half a character; the other half would have been joined to it.
_SURROGATE = re.compile("[\ud800-\udfff]")


def _refuse(constant: str) -> None:
    raise ValueError(constant)


def _strict_text(line: str | None) -> str | None:
    try:
        value = json.loads(line, object_pairs_hook=_Object, parse_constant=_refuse, parse_int=_Number, parse_float=_Number)
    except (ValueError, TypeError, RecursionError):
        return None
    if isinstance(value, _Object):
        found = [v for k, v in value if k == "text"]
    else:
        found = value if isinstance(value, list) else []
    if len(found) != 1 or type(found[0]) is not str or _SURROGATE.search(found[0]):
        return None
    return found[0]


@F.arrow_udf(T.StringType())
def strict_text(lines: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``text`` of ``{"text": "..."}`` or ``["..."]``.

    NULL where it is missing, not a string, doubled or holds half a surrogate pair, and where the line is not one JSON value
    from end to end.
    """
    for column in lines:
        for part in slices(column):
            yield pa.array([_strict_text(x) for x in part.to_pylist()], pa.string())


def text_field(line: Column) -> Column:
    """``text`` of a JSON object where it is a string, in JVM expressions.  Trailing characters are not refused."""
    parsed = F.try_parse_json(line)
    text = F.try_variant_get(parsed, "$.text", "variant")
    return F.when(F.schema_of_variant(text) == "STRING", F.try_variant_get(parsed, "$.text", "string"))


def parsed(line: Column) -> Column:
    """The value of any JSON text, NULL if malformed."""
    return F.try_parse_json(line)


def element(value: Column, index: int) -> Column:
    return F.try_variant_get(value, f"$[{index}]", "variant")


def field(value: Column, name: str, as_: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{name}", as_)


def is_array(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))


def is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def is_number(value: Column) -> Column:
    return F.rlike(F.schema_of_variant(value), F.lit(r"^(BIGINT|DOUBLE|DECIMAL)"))


def softlabel_document(ids: Column, sequence: Column) -> Column:
    """``{"protein_id_list": ids, "softlabel_seq": sequence}`` as JSON text."""
    return F.to_json(F.struct(ids.alias("protein_id_list"), sequence.alias("softlabel_seq")))


def tokens_text(tokens: Column) -> Column:
    return F.to_json(tokens)


def u16_tokens(text: Column) -> Column:
    """An array of JSON integers from 0 to 65535; NULL if any element is something else."""
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    kinds = F.forall(items, lambda x: F.schema_of_variant(x) == "BIGINT")
    numbers = F.transform(items, lambda x: F.try_variant_get(x, "$", "bigint"))
    fits = F.forall(numbers, lambda x: x.between(0, 65535))
    return F.when(kinds & fits, F.transform(numbers, lambda x: x.cast("int")))
