"""WARC archives written with an index first and read back by coalesced byte ranges (operator 7).

Each task writes one ``.warc.gz`` file (a gzip member a record) into shared storage and returns an index row for each
record: file, offset, length, URL, digest.  The index is stored before anything is read.  Selected records are then
grouped by file and sorted by offset; ranges with small gaps between them are read at once, and each record is
checked against its digest.  A task that is run again writes another file, and only the file whose index rows were
committed is ever read.

Duplicates are found on digests alone: of records with equal payloads of at least ``least`` bytes the one with the
smallest page id is a response and the others revisit it.

Defined cases: null html is an empty payload; a null url is written as an empty target; rows with the same page id are
told apart by their position in the table, the first of equal ids and payloads staying the response; a null page id comes
after all others, and revisits of a response without an id refer to none; an empty table gives an empty index; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh_path, stored, table, whole_groups

#: Payloads of fewer bytes are always written whole.
LEAST = 100
#: Ranges closer than GAP bytes are read together, up to MOST bytes at once.
GAP, MOST = 64 << 10, 8 << 20
INDEX = "file string, offset long, length long, url string, digest string, page_id long, payload_bytes long, record_type string, refers_to long"
_DATE = "2000-01-01T00:00:00Z"  # archives of the same pages are equal


def _clean(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, again: bool, refers_to: int | None, of: str | None) -> bytes:
    """One WARC record.  ``again``: a revisit, of the page ``refers_to`` with the url ``of``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    kind = "revisit" if again else "response"
    body = http + (b"" if again else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}|{digest}|{_clean(url)}')}>",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Full-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if again:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Target-URI: {_clean(of)}",
            f"WARC-Refers-To-Page-ID: {'' if refers_to is None else refers_to}",
        ]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers and its HTTP payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _storage(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = out = name = None
        at = 0
        for b in batches:
            if out is None and b.num_rows:
                fs, base = _storage(folder)
                fs.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            rows: list[tuple] = []
            for i in range(b.num_rows):
                x = {k: b.column(k)[i].as_py() for k in ("page_id", "url", "html", "digest", "again", "refers_to", "of")}
                payload = (x["html"] or "").encode()
                data = _member(record(x["page_id"], x["url"], payload, x["digest"], x["again"], x["refers_to"], x["of"]))
                out.write(data)
                rows.append((name, at, len(data), x["url"], x["digest"], x["page_id"], len(payload), "revisit" if x["again"] else "response", x["refers_to"]))
                at += len(data)
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip((c.split()[0] for c in INDEX.split(", ")), zip(*rows, strict=True), strict=True)), schema=_INDEX_SCHEMA)
        if out is not None:
            out.close()

    return run


_INDEX_SCHEMA = pa.schema(
    [(n, pa.string() if t == "string" else pa.int64()) for n, t in (c.split() for c in INDEX.split(", "))]
)


def write_archive(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files into ``folder``; the stored index is returned."""
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        "page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n"), F.monotonically_increasing_id().alias("place")
    )
    # one row for each payload that several records share; groups shrink before the shuffle
    same = (
        keyed.where(F.col("n") >= least)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.min_by(F.struct("page_id", "url", "place"), F.struct(F.col("page_id").isNull(), "page_id", "place")).alias("first"))
        .where("copies > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("of"), F.col("first.place").alias("at"))
    )
    same, _ = stored(same, "warc-copies")
    # rows of one table have the same places in both scans
    again = F.coalesce(F.col("place") != F.col("at"), F.lit(False))
    marked = keyed.join(same, "digest", "left").select(
        "page_id", "url", "html", "digest", again.alias("again"), F.when(again, F.col("first_id")).alias("refers_to"), "of"
    )
    index, _ = stored(marked.mapInArrow(_write(folder), INDEX), "warc-index")
    return index


def _read(folder: str, keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = base = None
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        n = len(names) - (not keep_payload)
        schema = pa.schema(list(zip(names[:n], kinds[:n], strict=True)))
        for t in whole_groups(batches, ["file", "chunk"]):
            if fs is None:
                fs, base = _storage(folder)
            rows: list[tuple] = []
            entries = list(zip(*(t.column(c).to_pylist() for c in ("file", "offset", "length", "digest")), strict=True))
            i = 0
            while i < len(entries):
                j, (file, start, length, _) = i + 1, entries[i]
                end = start + length
                while j < len(entries) and entries[j][0] == file and entries[j][1] - end <= GAP and entries[j][1] + entries[j][2] - start <= MOST:
                    end = max(end, entries[j][1] + entries[j][2])
                    j += 1
                with fs.open_input_file(f"{base}/{file}") as f:
                    block = f.read_at(end - start, start)
                for _, offset, length, digest in entries[i:j]:
                    fields, payload = parse(zlib.decompress(block[offset - start : offset - start + length], 31))
                    kind, page = fields["WARC-Type"], fields["WARC-Page-ID"]
                    size, found = int(fields["WARC-Full-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if found != digest or (kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size)):
                        raise OSError(f"{file} at {offset}: the record does not agree with its index")
                    to = fields.get("WARC-Refers-To-Page-ID")
                    rows.append((int(page) if page else None, size, found, kind, int(to) if to else None, payload if kind == "response" else None)[:n])
                i = j
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=False)), schema=schema)

    return run


def read_archive(index: DataFrame, folder: str, keep_payload: bool = False) -> DataFrame:
    """The records that ``index`` (any selection of rows) names, from the archives in ``folder``.

    Tasks get stretches of a file of about MOST bytes each, so one large file is read by many.
    """
    chosen = index.select("file", "offset", "length", "digest").withColumn("chunk", F.floor(F.col("offset") / MOST))
    laid = chosen.repartition("file", "chunk").sortWithinPartitions("file", "chunk", "offset")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * keep_payload
    return laid.mapInArrow(_read(folder, keep_payload), schema)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    return read_archive(write_archive(table(spark, sf_dir, "pages"), folder), folder)


OP7_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as n, sha256(html) as digest from p),
g as (select page_id, n, digest, first_value(page_id) over w as first_id, row_number() over w as k from d window w as (partition by digest order by page_id))
select page_id, n::bigint as payload_bytes, digest as payload_digest, case when n >= 100 and k > 1 then 'revisit' else 'response' end as record_type,
  case when n >= 100 and k > 1 then first_id end as refers_to
from g
"""
