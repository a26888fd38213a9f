"""Specifications of sources and sinks."""

from __future__ import annotations

import re
from dataclasses import dataclass
from enum import Enum

from .errors import ConfigError


class LineFormat(Enum):
    """A label of line files; all formats are read alike."""

    JSONL = "jsonl"
    TSV = "tsv"
    PLAIN = "plain"


class TokenUnit(Enum):
    """Units of token files: (code on disk, bytes, numpy type)."""

    U8 = (0, 1, "<u1")
    U16 = (1, 2, "<u2")
    F32 = (2, 4, "<f4")

    @property
    def code(self) -> int:
        return self.value[0]

    @property
    def size(self) -> int:
        return self.value[1]

    @property
    def dtype(self) -> str:
        return self.value[2]

    @staticmethod
    def of(code: int) -> TokenUnit:
        return next(u for u in TokenUnit if u.code == code)


@dataclass(frozen=True)
class Debug:
    prefix: str | None = None


@dataclass(frozen=True)
class Lines:
    path: str
    format: LineFormat = LineFormat.PLAIN
    limit: int | None = None


@dataclass(frozen=True)
class Xml:
    """Records as columns, or as one text each (``as_text``)."""

    path: str
    record_tag: str = "record"
    as_text: bool = False


@dataclass(frozen=True)
class Fasta:
    path: str


@dataclass(frozen=True)
class Fastq:
    path: str


@dataclass(frozen=True)
class Jdbc:
    """A table of PostgreSQL, MySQL or any database with a JDBC driver on the class path.

    An ``embedded`` database (in memory, or a file that one process holds open) lives in the driver alone.
    """

    url: str
    table: str
    driver: str | None = None
    partition_column: str | None = None
    lower: int | None = None
    upper: int | None = None
    partitions: int | None = None
    fetch: int = 10_000
    batch: int = 1_000

    @property
    def embedded(self) -> bool:
        return re.match("jdbc:(derby:(?!//)|h2:(?!tcp:|ssl:)|hsqldb:(?!hsqls?:|https?:)|sqlite:)", self.url) is not None


@dataclass(frozen=True)
class KeyValue:
    """Keys with a prefix in database ``db`` of a keyed table."""

    path: str
    db: int = 0
    prefix: str = ""


@dataclass(frozen=True)
class TokenFile:
    """File pairs ``<base_path>/<filename>_device_<n>``; ``devices=None`` makes one of each partition, without copying."""

    base_path: str
    filename: str
    devices: int | None = 1
    unit: TokenUnit = TokenUnit.U16
    units_per_token: int = 1
    legacy: bool = False
    context_length: int | None = None

    def __post_init__(self) -> None:
        if self.devices is not None and self.devices < 1 or self.units_per_token < 1:
            raise ConfigError("devices and units per token must be positive")
        if self.legacy and (self.unit is not TokenUnit.U16 or self.units_per_token != 1):
            raise ConfigError("the legacy format has one 16-bit unit a token")
        if self.context_length is not None and self.context_length < 1:
            raise ConfigError("the context length must be positive")

    @property
    def files(self) -> str:
        """The file pairs of all devices, split by commas."""
        numbers = ["*"] if self.devices is None else range(self.devices)
        return ",".join(f"{self.base_path}/{self.filename}_device_{d}" for d in numbers)


Endpoint = Debug | Lines | Xml | Fasta | Fastq | Jdbc | KeyValue | TokenFile
