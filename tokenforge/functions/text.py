"""String and binary expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The end-of-document character.
END = "\u0003"
_BLANK = r"(?U)^\s+|\s+$"


def with_end(text: Column) -> Column:
    """``text`` with the end-of-document character."""
    return F.concat(text, F.lit(END))


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def trim(text: Column) -> Column:
    """Trim all Unicode white space."""
    return F.regexp_replace(text, _BLANK, "")


def header_id(header: Column) -> Column:
    """The part of a FASTA header before the first white space."""
    return F.regexp_extract(header, r"(?Us)^(\S*)", 1)


def header_description(header: Column) -> Column:
    """The trimmed rest of a FASTA header, or NULL."""
    rest = trim(F.regexp_extract(header, r"(?Us)^\S*\s?(.*)$", 1))
    return F.when(rest != "", rest)


def first_field(line: Column) -> Column:
    """The first tab-separated field of a trimmed line; NULL for blank lines and empty fields."""
    field = F.split_part(trim(line), F.lit("\t"), F.lit(1))
    return F.when(field != "", field)


def key(prefix: str, id_: Column) -> Column:
    return F.concat(F.lit(prefix), id_.cast("string"))


def key_number(k: Column, prefix: str) -> Column:
    """The unsigned number after ``prefix``, else NULL."""
    rest = F.substr(k, F.lit(len(prefix) + 1))
    return F.when(F.startswith(k, F.lit(prefix)) & F.rlike(rest, F.lit(r"^\+?[0-9]+$")), rest.try_cast("bigint"))


def characters(text: Column) -> Column:
    """The Unicode scalars of a text as an array; empty for the empty text."""
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def wrapped(text: Column, width: int = 70) -> Column:
    """``text`` in lines of ``width`` characters (bytes, for sequences in ASCII)."""
    return F.regexp_replace(text, f"(?s)(.{{{width}}})(?=.)", "$1\n")


def fasta_record(id_: Column, description: Column, sequence: Column, width: int = 70) -> Column:
    """A FASTA record without the final line end; an empty sequence has no line."""
    tail = F.when(F.coalesce(description, F.lit("")) != "", F.concat(F.lit(" "), description)).otherwise("")
    body = F.when(sequence != "", F.concat(F.lit("\n"), wrapped(sequence, width))).otherwise("")
    return F.concat(F.lit(">"), id_, tail, body)


def display_pair(k: Column, value: Column) -> Column:
    return F.concat(k, F.lit(" -> "), value)


def display_fasta(id_: Column, description: Column, sequence: Column) -> Column:
    """One line for a FASTA item: its line end is shown as a backslash and n, beside its length in bytes."""
    head = F.concat(F.lit(">"), id_, F.when(description.isNotNull(), F.concat(F.lit(" "), description)).otherwise(""))
    return F.concat(head, F.lit("\\n"), F.octet_length(sequence).cast("string"))


def display_tokens(tokens: Column) -> Column:
    """Fixed format."""
    return F.format_string("MmapItem(units_count: %d)", F.size(tokens))


def byte_size(n: int) -> str:
    """A number of bytes for people."""
    for unit, name in ((1 << 30, "GiB"), (1 << 20, "MiB"), (1 << 10, "KiB")):
        if n >= unit:
            return f"{n / unit:.2f} {name}"
    return f"{n} B"
