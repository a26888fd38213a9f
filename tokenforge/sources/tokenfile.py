"""Indexed token files (``.bin`` and ``.idx``) as a Spark data source, to read and to write.

Reading: the driver reads a header of fixed size; tasks get ranges of lines and read their own parts of index and data.
Filters on ``line`` bound the ranges.  Writing: each task writes a shard of its own, ``commit`` names the shards that
count, and then one task a device lays its shards one after the other in partition order and writes its index.  A task
that runs again writes another shard or file, and only committed ones are used.  Without a number of devices each
partition is one: no shard is copied, only renamed.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator
from contextlib import nullcontext
from dataclasses import dataclass
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..endpoints import TokenFile, TokenUnit
from ..errors import ConfigError
from ..functions.primes import magic_prime

# Fixed values of the format.
MAGIC = b"MMIDIDX\x00\x00"
LEGACY_VERSION, VERSION = 1, 2
LEGACY_CODE = 8
LINES_A_TASK, LINES_A_BATCH = 200_000, 4096
#: Bytes of data for a task and for a batch (one longer line is taken alone).
BYTES_A_TASK, BYTES_A_BATCH = 1 << 24, 1 << 20


def storage(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def header(lines: int, unit: TokenUnit, units: int, legacy: bool) -> bytes:
    """The part of an index before its arrays."""
    kind = struct.pack("<QB", LEGACY_VERSION, LEGACY_CODE) if legacy else struct.pack("<QBI", VERSION, unit.code, units)
    return MAGIC + kind + struct.pack("<QQ", lines, lines + 1)


@dataclass(frozen=True)
class Header:
    unit: TokenUnit
    units: int
    legacy: bool
    lines: int
    size: int

    @staticmethod
    def parse(raw: bytes) -> Header:
        if raw[:9] != MAGIC:
            raise ConfigError("not an index of a token file")
        (version,) = struct.unpack_from("<Q", raw, 9)
        if version == LEGACY_VERSION:
            if raw[17] != LEGACY_CODE:
                raise ConfigError("a legacy file of another unit")
            return Header(TokenUnit.U16, 1, True, struct.unpack_from("<Q", raw, 18)[0], 34)
        if version != VERSION:
            raise ConfigError(f"version {version} is not known")
        code, units = struct.unpack_from("<BI", raw, 17)
        if code > 2 or units < 1:
            raise ConfigError("an unknown unit")
        return Header(TokenUnit.of(code), units, False, struct.unpack_from("<Q", raw, 22)[0], 38)


class _Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int, head: Header, first: int) -> None:
        self.path, self.start, self.stop, self.head, self.first = path, start, stop, head, first


def _schema(unit: str, index_only: bool = False) -> str:
    tokens = "" if index_only else f", tokens array<{'float' if unit == 'f32' else 'int'}>"
    return f"file string, line long, num_tokens long{tokens}"


def _existing(paths: list[str], missing: str) -> list[str]:
    """``paths`` with ``*`` in file names expanded; those without an index are left out where ``missing`` is ``empty``."""
    out = []
    for path in paths:
        fs, base = storage(path + ".idx")
        folder, _, name = base.rpartition("/")
        if "*" in name:
            pattern = re.compile(re.escape(name).replace(r"\*", "(.*)"))
            found = [PurePosixPath(f.path).name for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))]
            number = lambda n: [int(x) if x.isdigit() else 0 for x in pattern.fullmatch(n).groups()]
            found = sorted((n for n in found if pattern.fullmatch(n)), key=lambda n: (number(n), n))
            if not found and missing != "empty":
                raise ConfigError(f"no index matches {path}")
            out += [path.rpartition("/")[0] + "/" + n[: -len(".idx")] for n in found]
        elif missing != "empty" or fs.get_file_info(base).type != pafs.FileType.NotFound:
            out.append(path)
    return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths = _existing([p for p in options["path"].split(",") if p], options.get("missing", "error"))
        self.index_only = options.get("columns") == "index"
        self.expect = TokenUnit[options["unit"].upper()] if "unit" in options else None
        self.units = int(options["unitspertoken"]) if "unitspertoken" in options else None
        self.lines = int(options.get("linespertask", LINES_A_TASK))
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if getattr(f, "attribute", None) == ("line",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, EqualTo):
                    self.low, self.high = max(self.low, f.value), min(self.high, f.value + 1)
                elif isinstance(f, GreaterThanOrEqual | GreaterThan):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                elif isinstance(f, LessThanOrEqual | LessThan):
                    self.high = min(self.high, f.value + isinstance(f, LessThanOrEqual))
            yield f  # Spark checks the rows again

    def _parts(self, fs: pafs.FileSystem, idx: str, head: Header, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Ranges of lines of BYTES_A_TASK bytes at most: where a range holds more, its middle line's offset is looked up, and so on.

        So the driver reads some offsets a task, not the index.
        """
        todo = [(lo, hi)]
        if self.index_only:
            yield from todo
            return
        with fs.open_input_file(idx) as index:
            at = lambda line: struct.unpack("<Q", index.read_at(8, head.size + 4 * head.lines + 8 * line))[0]
            while todo:
                lo, hi = todo.pop()
                if hi - lo > 1 and at(hi) - at(lo) > BYTES_A_TASK:
                    middle = (lo + hi) // 2
                    todo += [(middle, hi), (lo, middle)]
                else:
                    yield lo, hi

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.paths:
            fs, base = storage(path + ".idx")
            with fs.open_input_file(base) as f:
                head = Header.parse(f.read(38))
            if self.expect and head.unit is not self.expect or self.units and head.units != self.units:
                raise ConfigError(f"{path} holds {head.units} x {head.unit.name} a token")
            for first in range(max(0, self.low), min(head.lines, self.high), self.lines):
                for lo, hi in self._parts(fs, base, head, first, min(first + self.lines, head.lines, self.high)):
                    out.append(_Range(path, lo, hi, head, lo))
        return out or [_Range("", 0, 0, Header(TokenUnit.U8, 1, False, 0, 0), 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        head, n = partition.head, partition.head.lines
        if partition.stop <= partition.start:
            return
        (fs, idx), (_, data) = storage(partition.path + ".idx"), storage(partition.path + ".bin")
        kind = pa.float32() if head.unit is TokenUnit.F32 else pa.int32()
        size = fs.get_file_info(data).size
        with fs.open_input_file(idx) as index, nullcontext() if self.index_only else fs.open_input_file(data) as body:
            for lo in range(partition.start, partition.stop, LINES_A_BATCH):
                hi = min(lo + LINES_A_BATCH, partition.stop)
                counts = np.frombuffer(index.read_at(4 * (hi - lo), head.size + 4 * lo), "<u4").astype(np.int64)
                offsets = np.frombuffer(index.read_at(8 * (hi - lo), head.size + 4 * n + 8 * lo), "<u8").astype(np.int64)
                ends = offsets + counts * head.units * head.unit.size
                good = np.flatnonzero(ends <= size)  # lines beyond the file's end are left out
                if not len(good):
                    continue
                known = [pa.array([partition.path] * len(good)), pa.array(good + lo, pa.int64()), pa.array(counts[good])]
                if self.index_only:
                    yield pa.RecordBatch.from_arrays(known, names=["file", "line", "num_tokens"])
                    continue
                sums, a = np.cumsum(ends[good] - offsets[good]), 0
                while a < len(good):
                    b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + BYTES_A_BATCH, "right")))
                    some = good[a:b]
                    start, stop = int(offsets[some].min()), int(ends[some].max())
                    raw = body.read_at(stop - start, start)
                    parts = [np.frombuffer(raw[offsets[i] - start : ends[i] - start], head.unit.dtype) for i in some]
                    flat = np.concatenate(parts).astype(kind.to_pandas_dtype())
                    edges = np.concatenate(([0], np.cumsum(counts[some] * head.units)))
                    tokens = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, kind))
                    yield pa.RecordBatch.from_arrays([*(x.slice(a, b - a) for x in known), tokens], names=["file", "line", "num_tokens", "tokens"])
                    a = b


class _Shard(WriterCommitMessage):
    def __init__(self, partition: int, name: str, lines: int, size: int, tokens: int) -> None:
        self.partition, self.name, self.lines, self.size, self.tokens = partition, name, lines, size, tokens


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All units of a column of lists (or of bytes) and each row's number of them; NULL rows are empty."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        rows = pc.fill_null(column, b"").cast(pa.large_binary())
        off = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]
        data = rows.buffers()[2]
        flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
        return flat, np.diff(off)
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    if flat.null_count:
        raise ConfigError("a NULL unit")
    return flat.to_numpy(zero_copy_only=False), counts


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.spec = TokenFile(
            options["path"].rstrip("/"),
            options["filename"],
            int(options["devices"]) if "devices" in options else None,
            TokenUnit[options.get("unit", "u16").upper()],
            int(options.get("unitspertoken", 1)),
            options.get("legacy", "false").lower() == "true",
            int(options["contextlength"]) if "contextlength" in options else None,
        )
        self.at = schema.fieldNames().index("tokens") if "tokens" in schema.fieldNames() else 0
        self.job = options.get("job") or uuid.uuid4().hex
        self.later = "job" in options

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Shard:
        from pyspark import TaskContext

        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        spec, unit = self.spec, self.spec.unit
        fs, base = storage(spec.base_path)
        fs.create_dir(base, recursive=True)
        name = f".{self.job}-{partition}-{uuid.uuid4().hex}"
        lines = size = total = 0
        try:
            with fs.open_output_stream(f"{base}/{name}.bin") as body, fs.open_output_stream(f"{base}/{name}.len") as index:
                for batch in batches:
                    x, counts = _units(batch.column(self.at))
                    if (counts % spec.units_per_token).any():
                        raise ConfigError(f"a line's units are no whole tokens of {spec.units_per_token}")
                    if unit is not TokenUnit.F32 and len(x) and (x.min() < 0 or x.max() >= 1 << 8 * unit.size):
                        raise ConfigError(f"a unit does not fit {unit.name}")
                    tokens = counts // spec.units_per_token
                    if len(tokens) and tokens.max() > 0xFFFFFFFF:
                        raise ConfigError("a line of too many tokens")
                    raw = x.astype(unit.dtype).tobytes()
                    body.write(raw)
                    index.write(tokens.astype("<u4").tobytes())
                    lines, size, total = lines + len(tokens), size + len(raw), total + int(tokens.sum())
        except BaseException:
            for end in ("bin", "len"):  # a task that fails leaves nothing
                if fs.get_file_info(f"{base}/{name}.{end}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{base}/{name}.{end}")
            raise
        return _Shard(partition, name, lines, size, total)

    def commit(self, messages: list[_Shard | None]) -> None:
        spec = self.spec
        fs, base = storage(spec.base_path)
        fs.create_dir(base, recursive=True)
        shards = [(m.name, m.lines) for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition)]
        devices = spec.devices or max(1, len(shards))
        if self.later:
            with fs.open_output_stream(f"{base}/.{self.job}-shards") as out:
                out.write(json.dumps([devices, shards]).encode())
            return
        for d in range(devices):
            _lay(spec, self.job, d, shards[d::devices])
        _clear(spec, self.job)

    def abort(self, messages: list[_Shard | None]) -> None:
        _clear(self.spec, self.job)


def _clear(spec: TokenFile, job: str) -> None:
    fs, base = storage(spec.base_path)
    for f in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
        if PurePosixPath(f.path).name.startswith(f".{job}-"):
            fs.delete_file(f.path)


def _lay(spec: TokenFile, job: str, device: int, shards: list[tuple[str, int]]) -> None:
    """The file pair of a device from its shards ``(name, lines)``; it appears by renaming, and may be made again."""
    fs, base = storage(spec.base_path)
    target, own = f"{base}/{spec.filename}_device_{device}", f"{base}/.{job}-{uuid.uuid4().hex}"
    width, lines = spec.unit.size * spec.units_per_token, sum(n for _, n in shards)
    with fs.open_output_stream(f"{own}.idx") as out:
        out.write(header(lines, spec.unit, spec.units_per_token, spec.legacy))
        for name, _ in shards:
            _copy(fs, f"{base}/{name}.len", out)
        at = 0
        for name, _ in shards:
            with fs.open_input_stream(f"{base}/{name}.len") as f:
                while raw := f.read(1 << 22):
                    ends = np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64) * width)
                    out.write((at + np.concatenate(([0], ends[:-1]))).astype("<u8").tobytes())
                    at += int(ends[-1])
        out.write(struct.pack("<Q", at))
        for lo in range(0, lines + 1, 1 << 20):
            out.write(np.arange(lo, min(lo + (1 << 20), lines + 1), dtype="<u8").tobytes())
    if len(shards) == 1:
        # renamed by an attempt before this one
        if fs.get_file_info(f"{base}/{shards[0][0]}.bin").type != pafs.FileType.NotFound:
            fs.move(f"{base}/{shards[0][0]}.bin", f"{target}.bin")
    else:
        with fs.open_output_stream(f"{own}.bin") as out:
            for name, _ in shards:
                _copy(fs, f"{base}/{name}.bin", out)
        fs.move(f"{own}.bin", f"{target}.bin")
    fs.move(f"{own}.idx", f"{target}.idx")


def _copy(fs: pafs.FileSystem, source: str, out) -> None:
    with fs.open_input_stream(source) as f:
        while raw := f.read(1 << 22):
            out.write(raw)


def _plain(options) -> dict[str, str]:
    """Options by lower-case name, as Spark's own sources take them in any case."""
    return {k.lower(): v for k, v in options.items()}


class TokenFileSource(DataSource):
    """``tokenfile``: options unit (u8, u16, f32), unitsPerToken, filename, devices, legacy, contextLength, linesPerTask.

    ``columns=index`` reads lines and their lengths without the data, ``missing=empty`` passes over files that do not exist.
    """

    @classmethod
    def name(cls) -> str:
        return "tokenfile"

    def schema(self) -> str:
        options = _plain(self.options)
        return _schema(options.get("unit", "u16").lower(), options.get("columns") == "index")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_plain(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(_plain(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenFileSource)


def read_tokens(
    spark: SparkSession, path: str, unit: TokenUnit = TokenUnit.U16, units_per_token: int = 1, missing: str = "error", index_only: bool = False
) -> DataFrame:
    """``(file, line, num_tokens, tokens)`` of the file pair ``path.idx`` and ``path.bin`` (several split by commas; ``*``
    in the name stands for any).  ``index_only``: without ``tokens``, and the data is not read."""
    register(spark)
    options = {"unit": unit.name.lower(), "unitsPerToken": units_per_token, "missing": missing, "columns": "index" if index_only else "all"}
    return spark.read.format("tokenfile").options(**options).load(path)


def line_count(path: str) -> int:
    """The number of lines of file pairs, from the fixed part of each index alone."""
    total = 0
    for p in _existing([p for p in path.split(",") if p], "error"):
        fs, base = storage(p + ".idx")
        with fs.open_input_file(base) as f:
            total += Header.parse(f.read(38)).lines
    return total


def write_tokens(df: DataFrame, spec: TokenFile) -> int | None:
    """Write ``tokens`` of ``df`` in its order of partitions; the magic prime where a context length is given."""
    from pyspark.sql import functions as F

    spark = df.sparkSession
    register(spark)
    job = uuid.uuid4().hex
    options = {"path": spec.base_path, "filename": spec.filename, "unit": spec.unit.name.lower(), "unitsPerToken": spec.units_per_token, "legacy": str(spec.legacy).lower(), "job": job}
    if spec.devices is not None:
        options["devices"] = spec.devices
    df.select("tokens").write.format("tokenfile").mode("append").options(**options).save()
    fs, base = storage(spec.base_path)
    with fs.open_input_stream(f"{base}/.{job}-shards") as f:
        devices, shards = json.loads(f.read())

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d in b.column(0).to_pylist():
                _lay(spec, job, d, shards[d::devices])
            yield b

    spark.range(0, devices, 1, devices).mapInArrow(lay, "id long").foreach(lambda _: None)
    _clear(spec, job)
    if spec.context_length is None:
        return None
    lengths = read_tokens(spark, spec.files, spec.unit, spec.units_per_token, index_only=True)
    return magic_prime(lengths.agg(F.sum("num_tokens").alias("n")).collect()[0]["n"] or 0, spec.context_length)
