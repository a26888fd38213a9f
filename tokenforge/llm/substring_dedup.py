"""Exact substring removal by column-wise construction of a collection BWT with common prefixes (operator 1).

Every byte covered by a string of ``width`` bytes that also starts elsewhere is removed.

Inserting one symbol of every document a round would take as many passes over all data as the longest document has
bytes.  So the collection is first dealt out by content: each window of ``width`` bytes is owned by its anchor, the
leftmost gram of GRAM bytes with the smallest hash in it.  Equal windows have equal anchors at equal offsets, so all
occurrences of a repeated window lie in contexts (the stretch of text whose windows one anchor owns) of one gram.
Contexts that are equal as a whole, and grams that own one context only, are settled by counting.  The rest, the
contexts that differ beside a shared gram, are the documents of small collections: aligned at their anchors, one symbol
of each is inserted a round, from the last column to the first, and the suffix order (the transform's permutation), the
symbols before it and the longest common prefixes of neighbours are updated from the round before.  The columns lie in
a file that is read once in sequence, so a task holds a few numbers a context, not the text.  A window repeats exactly
where its suffix shares ``width`` symbols with a neighbour.

Grams of more than HOT contexts would be collections that no task should hold.  Their windows are told apart one by one, by
128 bits of gram and window hash, and counted: of some half a million of them a batch sends each once and settles the repeats
itself, so a passage that very many documents hold is a row or a few a batch for its key.  Equal texts are worked on once.  Texts
are only moved for contexts that are compared and, packed and once a batch, where they lose bytes; documents meet the results.

Texts are told apart by 128-bit digests, equal contexts by 128 bits of gram and context hash.

An executor's memory holds a worker for each Python step of a task beside the heap.  So no stage has two such steps, texts and
windows of a batch are worked on in pieces (of contexts, a few numbers each are held for the whole batch), and a worker
gives back what it has freed.

Defined cases: null text is empty; texts of fewer bytes than ``width`` lose nothing; repeated rows are documents of
their own, so both lose what they share; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .shared import fresh_path, lean, made_filter, spread, stored, table, whole_groups

WIDTH, GRAM = 200, 64
#: Grams with more contexts are counted by windows.
HOT = 4096
#: Distinct texts that are copied out of a batch at once, strings that are sent at once, and windows, about, that are sorted at once.
TEXTS, STRINGS, WINDOWS = 512, 4096, 1 << 19
_TURN = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def text_digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _heads(digests: list[bytes] | pa.Array) -> np.ndarray:
    """The first 64 bits of digests, by which filters hold them and rows are spread."""
    joined = b"".join(digests if isinstance(digests, list) else digests.to_pylist())
    return np.ascontiguousarray(np.frombuffer(joined, np.int64).reshape(-1, 2)[:, 0])


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each position on."""
    h, size, base = text.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while size < GRAM:
        if len(h) <= size:
            return h[:0]
        h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
    return tk.mix(h)


def anchors(text: np.ndarray, own: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, first window, last window, anchor) of all contexts in a slice of texts."""
    n = len(text)
    empty = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    if n < width:
        return empty
    h = gram_hashes(text)
    bits = np.uint64(max(1, int(n).bit_length()))
    place = np.uint64((1 << int(bits)) - 1)
    m = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    grams, size = width - GRAM + 1, 1
    while size * 2 <= grams:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < grams:
        m = np.minimum(m[: len(m) - (grams - size)], m[grams - size :])
    # windows that lie in one text
    valid = np.zeros(n + 1, np.int8)
    long = own[1:] - own[:-1] >= width
    valid[own[:-1][long]] += 1
    valid[own[1:][long] - width + 1] -= 1
    at = np.flatnonzero(np.cumsum(valid)[: len(m)])
    if not len(at):
        return empty
    a = (m[at] & place).astype(np.int64)
    start = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1))))
    end = np.concatenate((start[1:], [len(at)])) - 1
    lo, hi, a = at[start], at[end], a[start]
    stop = hi + width
    c = (hi - lo).astype(np.uint64) * np.uint64(1 << 32) + (a - lo).astype(np.uint64)
    # six blocks of GRAM bytes, from both ends, cover a context
    for k, p in enumerate((lo, lo + GRAM, lo + 2 * GRAM, stop - GRAM, stop - 2 * GRAM, stop - 3 * GRAM)):
        c = c + tk.mix(h[p] + _TURN[k]) * _TURN[k]
    return h[a], tk.mix(c), lo, hi, a


def _distinct(column: pa.Array) -> tuple[list[bytes], list[int], list[int]]:
    """Digests and byte lengths of all rows, and the rows that are the first of their digest."""
    digests, sizes, first, seen = [], [], [], set()
    for i, x in enumerate(column):
        raw = x.as_buffer() if x.is_valid else b""
        raw = raw.to_pybytes() if raw is not None and not isinstance(raw, bytes) else (raw or b"")
        d = text_digest(raw)
        digests.append(d)
        sizes.append(len(raw))
        if d not in seen:
            seen.add(d)
            first.append(i)
    return digests, sizes, first


def _contexts(column: pa.Array, first: list[int], width: int) -> Iterator[tuple]:
    """Contexts of the distinct texts of a batch, a slice at a time: arrays (texts by their row in the batch) and the
    slice's bytes and offsets."""
    for s in range(0, len(first), TEXTS):
        names = np.array(first[s : s + TEXTS], np.int64)
        buf, off = tk.flat(column.take(pa.array(names)))
        for a, b in tk.slices(off):
            text, own = buf[off[a] : off[b]], off[a : b + 1] - off[a]
            h, c, lo, hi, at = anchors(text, own, width)
            row = np.searchsorted(own, lo, "right") - 1
            yield h.view(np.int64), c.view(np.int64), names[a + row], lo - own[row], hi - own[row], at - own[row], text, own[row]


_FIRST = "h long, salt int, c long, t binary, place long, flag int"
_FIRST_SCHEMA = pa.schema([("h", pa.int64()), ("salt", pa.int32()), ("c", pa.int64()), ("t", pa.binary()), ("place", pa.int64()), ("flag", pa.int32())])
#: Flags: what a batch knows of a context.
DOC, MULTI, SAME = -1, 1, 2


def _first_rows(h, salt, c, names: pa.Array, t, place, flag) -> Iterator[pa.RecordBatch]:
    for s in range(0, len(h), 1 << 16):
        part = slice(s, s + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[part]), pa.array(salt[part], pa.int32()), pa.array(c[part]), names.take(pa.array(t[part])), pa.array(place[part]), pa.array(flag[part], pa.int32())],
            schema=_FIRST_SCHEMA,
        )


def _window_rows(parts: list[tuple[np.ndarray, ...]], names: pa.Array, heads: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each of these windows once (SAME where it is here again), and stretches of the others."""
    h, c, t, start = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    order = np.lexsort((c, h))
    h, c, t, start = h[order], c[order], t[order], start[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
    last = np.concatenate((new[1:], [True]))
    one = np.flatnonzero(new)
    yield from _first_rows(h[one], np.zeros(len(one)), c[one], names, t[one], start[one] << 8, np.where(last[one], 0, SAME))
    again = np.flatnonzero(~new)
    if len(again):
        again = again[np.lexsort((start[again], t[again]))]
        t, start = t[again], start[again]
        run = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (start[1:] != start[:-1] + 1))))
        # a stretch is at most 200 windows long, as its place has eight bits for that
        long = np.diff(np.concatenate((run, [len(t)])))
        cuts = -(-long // 200)
        at = np.repeat(run, cuts) + 200 * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        size = np.diff(np.concatenate((at, [len(t)])))
        zero = np.zeros(len(at), np.int64)
        own = tk.mix(heads[t[at]].view(np.uint64) + start[at].astype(np.uint64)).view(np.int64)
        yield from _first_rows(own, zero + 1, zero, names, t[at], start[at] << 8 | size - 1, zero + SAME)


def _windows(shared, width: int):
    """The windows of hot grams, each once for about WINDOWS of a batch, as :func:`_window_rows` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, hot = shared.value
        for b in batches:
            column = b.column("text")
            digests, _, first = _distinct(column)
            if not digests:
                continue
            names, heads = pa.array(digests, pa.binary()), _heads(digests)
            parts, held = [], 0
            for h, _, t, lo, hi, _, text, base in _contexts(column, first, width):
                at = np.flatnonzero(hot.has(h)) if len(h) else np.zeros(0, np.int64)
                if not len(at):
                    continue
                size = hi[at] - lo[at] + 1
                own = np.repeat(at, size)
                start = lo[own] + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
                grams, p = gram_hashes(text), base[own] + start
                c = np.zeros(len(p), np.uint64)
                # blocks of GRAM bytes, from both ends, cover a window
                for k, q in enumerate([*range(0, width - GRAM, GRAM), width - GRAM]):
                    c += tk.mix(grams[p + q] + _TURN[k % len(_TURN)]) * _TURN[k % len(_TURN)]
                parts.append((h[own], tk.mix(c).view(np.int64), t[own], start))
                held += len(own)
                if held >= WINDOWS:
                    yield from _window_rows(parts, names, heads)
                    held = 0
            if parts:
                yield from _window_rows(parts, names, heads)

    return run


def _first(width: int):
    """Contexts of distinct texts, with what their batch shows, and a row for each document (flag DOC)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("text")
            digests, sizes, first = _distinct(column)
            if not digests:
                continue
            k, names, heads = len(digests), pa.array(digests, pa.binary()), _heads(digests)
            dealt = tk.mix(heads.view(np.uint64) + np.arange(k, dtype=np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt), pa.array(np.full(k, -1, np.int32)), pa.array(np.zeros(k, np.int64)), names, pa.array(sizes, pa.int64()), pa.array(np.full(k, DOC, np.int32))],
                schema=_FIRST_SCHEMA,
            )
            parts = [(h, c, t, lo << 8 | hi - lo) for h, c, t, lo, hi, *_ in _contexts(column, first, width) if len(h)]
            if not parts:
                continue
            h, c, t, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            del parts
            order = np.lexsort((c, h))
            h, c, t, place = h[order], c[order], t[order], place[order]
            new_h = np.concatenate(([True], h[1:] != h[:-1]))
            new_c = new_h | np.concatenate(([True], c[1:] != c[:-1]))
            last_c = np.concatenate((new_c[1:], [True]))
            flag = np.where(new_c & last_c, 0, SAME).astype(np.int32)
            group = np.cumsum(new_h) - 1
            kinds = np.bincount(group, new_c)
            flag[new_c & (kinds[group] > 1)] |= MULTI
            # repeats, and contexts between a gram's first and last, need not meet the common group
            ends = new_c & (new_h | (np.cumsum(new_c) == np.cumsum(kinds).astype(np.int64)[group]))
            salt = np.where(ends, 0, np.where(new_c, 2 + (c & 63), 2 + (heads[t] & 63))).astype(np.int32)
            yield from _first_rows(h, salt, c, names, t, place, flag)

    return run


_STRINGS = "h long, t binary, start long, back int, text binary"
_STRINGS_SCHEMA = pa.schema([("h", pa.int64()), ("t", pa.binary()), ("start", pa.int64()), ("back", pa.int32()), ("text", pa.binary())])


def _strings(shared, width: int):
    """Contexts of grams in the filter that are not hot, each once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, hot = shared.value
        for b in batches:
            column = b.column("text")
            digests, _, first = _distinct(column)
            parts = []
            for h, c, t, lo, hi, at, *_ in _contexts(column, first, width):
                told = wanted.has(h)
                if hot is not None:
                    told &= ~hot.has(h)
                parts.append([x[told] for x in (h, c, t, lo, hi, at)])
            if not parts:
                continue
            h, c, t, lo, hi, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            del parts
            order = np.lexsort((c, h))
            new = np.concatenate(([True], (h[order[1:]] != h[order[:-1]]) | (c[order[1:]] != c[order[:-1]])))[: len(h)]
            one = np.sort(order[new])
            for s in range(0, len(one), STRINGS):
                part = one[s : s + STRINGS]
                texts = [column[i].as_buffer()[a:b].to_pybytes() for i, a, b in zip(t[part].tolist(), lo[part].tolist(), (hi[part] + width).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[part]),
                        pa.array([digests[i] for i in t[part].tolist()], pa.binary()),
                        pa.array(lo[part]),
                        pa.array((at - lo)[part], pa.int32()),
                        pa.array(texts, pa.binary()),
                    ],
                    schema=_STRINGS_SCHEMA,
                )

    return run


class Columns:
    """Strings aligned at their anchors, as symbols by column in an external file, from the last column on.

    A symbol is a byte plus one; 0 stands where a string has none.  The file is written and read once in sequence, in the
    shared folder (or in memory, without one), a block of columns at a time.
    """

    def __init__(self, texts: list[bytes], back: np.ndarray, folder: str | None = None) -> None:
        size = np.array([len(x) for x in texts], np.int64)
        self.left = int(back.max())
        self.width = int((size - back).max()) + self.left
        self.rows = len(texts)
        self.step = max(1, (1 << 20) // max(1, 2 * self.rows))
        flat = np.frombuffer(b"".join(texts) or b"\0", np.uint8)
        begin, shift = np.cumsum(size) - size, self.left - back
        self.fs = self.path = None
        if folder is None:
            self.file = out = io.BytesIO()
        else:
            self.fs, base = pafs.FileSystem.from_uri(folder)
            self.fs.create_dir(base, recursive=True)
            self.path = f"{base}/{uuid.uuid4().hex}"
            out = self.fs.open_output_stream(self.path)
        for lo, hi in self._blocks():
            at = np.arange(hi - 1, lo - 1, -1)[:, None] - shift[None]
            there = (at >= 0) & (at < size)
            symbols = flat[np.where(there, at + begin, 0)].astype(np.uint16) + np.uint16(1)
            out.write(np.where(there, symbols, np.uint16(0)).tobytes())
        if self.path is None:
            out.seek(0)
        else:
            out.close()
            self.file = self.fs.open_input_stream(self.path)

    def _blocks(self) -> Iterator[tuple[int, int]]:
        for hi in range(self.width, 0, -self.step):
            yield max(0, hi - self.step), hi

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        """(column, its symbols), from the last column to the first."""
        try:
            for lo, hi in self._blocks():
                block = np.frombuffer(self.file.read(2 * (hi - lo) * self.rows), np.uint16).reshape(hi - lo, self.rows)
                for k in range(hi - lo):
                    yield hi - 1 - k, block[k]
        finally:
            self.file.close()
            if self.path is not None:
                self.fs.delete_file(self.path)


def repeated_windows(columns: Columns, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(column, strings) for every column at which windows start that also start elsewhere."""
    m = columns.rows
    order = np.arange(m)  # of the suffixes from the last column on
    common = np.zeros(m + 1, np.int32)  # common[k]: symbols that suffixes k - 1 and k share; common[m] closes ranges
    for column, symbols in columns:
        bwt = symbols[order]  # the symbols before the suffixes, in their order
        to = np.argsort(bwt, kind="stable")
        sorted_ = bwt[to]
        # between two neighbours of one symbol the shortest common prefix on the way counts
        least = np.minimum.reduceat(common, to + 1)
        order = order[to]
        common = np.zeros(m + 1, np.int32)
        same = (sorted_[1:] == sorted_[:-1]) & (sorted_[1:] > 0)
        common[1:m][same] = least[:-1][same] + 1
        far = common >= width
        if far.any():
            yield column, order[far[:-1] | far[1:]]


_SPANS = pa.schema([("t", pa.binary()), ("start", pa.int64()), ("stop", pa.int64())])


def _repeats(width: int, folder: str | None = None):
    """Repeated stretches ``(t, start, stop)`` from strings grouped by ``h``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["h"]):
            if t.num_rows < 2:
                continue
            names, start, back = t.column("t").combine_chunks(), t.column("start").to_numpy(), t.column("back").to_numpy()
            columns = Columns([x.as_py() for x in t.column("text")], back, folder)
            who, where = [], []
            for column, strings in repeated_windows(columns, width):
                who.append(strings)
                where.append(np.full(len(strings), column))
            if not who:
                continue
            who, where = np.concatenate(who), np.concatenate(where)
            order = np.lexsort((where, who))
            who, where = who[order], where[order]
            new = np.concatenate(([True], (who[1:] != who[:-1]) | (where[1:] != where[:-1] + 1)))
            lo = np.flatnonzero(new)
            hi = np.concatenate((lo[1:], [len(who)])) - 1
            s = start[who[lo]] + where[lo] - columns.left + back[who[lo]]
            e = start[who[lo]] + where[hi] - columns.left + back[who[lo]] + width
            yield pa.RecordBatch.from_arrays([names.take(pa.array(who[lo])), pa.array(s), pa.array(e)], schema=_SPANS)

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open spans."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text as one packed row, from rows grouped by ``t``."""
    schema = pa.schema([("t", pa.binary()), ("head", pa.int64()), ("spans", pa.binary())])
    for table_ in whole_groups(batches, ["t"]):
        t = table_.column("t").combine_chunks()
        s, e = (table_.column(c).to_numpy() for c in ("start", "stop"))
        halves = np.frombuffer(b"".join(t.to_pylist()), np.int64).reshape(-1, 2)
        edge = np.flatnonzero(np.concatenate(([True], (halves[1:] != halves[:-1]).any(1))))
        stop = np.concatenate((edge[1:], [len(t)]))
        packed = [np.array(merged(list(zip(s[a:b].tolist(), e[a:b].tolist(), strict=True))), np.int64).tobytes() for a, b in zip(edge, stop, strict=True)]
        yield pa.RecordBatch.from_arrays([t.take(pa.array(edge)), pa.array(halves[edge, 0]), pa.array(packed, pa.binary())], schema=schema)


_ROWS = "doc_id long, t binary, n_bytes long, sha string"
_TEXTS_SCHEMA = pa.schema([("t", pa.binary()), ("text", pa.binary())])
#: Bytes of packed texts of a batch, about.
PACKED = 1 << 22


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by digest, with the hash of their whole text."""
    for b in batches:
        digests, sizes, first = _distinct(b.column("text"))
        sha = {digests[i]: hashlib.sha256((b.column("text")[i].as_py() or "").encode()).hexdigest() for i in first}
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array([sha[d] for d in digests], pa.string())],
            names=["doc_id", "t", "n_bytes", "sha"],
        )


def _texts(shared):
    """The texts that may lose bytes, packed, each once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        losing = shared.value
        for b in batches:
            column = b.column("text")
            digests, _, first = _distinct(column)
            may = losing.has(_heads(digests)) if digests else np.zeros(0, bool)
            names, packed, held = [], [], 0
            for i in first:
                if may[i]:
                    names.append(digests[i])
                    packed.append(zlib.compress((column[i].as_py() or "").encode(), 1))
                    held += len(packed[-1])
                if held > PACKED:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(packed, pa.binary())], schema=_TEXTS_SCHEMA)
                    names, packed, held = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(packed, pa.binary())], schema=_TEXTS_SCHEMA)

    return run


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What texts lose, by digest, and the hash of what is left."""
    for b in batches:
        removed, counts, shas = [], [], []
        for text, packed in zip(b.column("text"), b.column("spans"), strict=True):
            spans = np.frombuffer(packed.as_py(), np.int64).reshape(-1, 2).tolist()
            removed.append(sum(e - s for s, e in spans))
            counts.append(len(spans))
            shas.append(hashlib.sha256(kept_bytes(zlib.decompress(text.as_py()), spans)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("t"), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas, pa.string())],
            names=["t", "n_removed", "n_spans", "kept"],
        )


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(t, head, spans)``: by text digest (and its first 64 bits), the maximal stretches of ``docs(text)`` that repeat, as
    packed pairs of int64."""
    spark = docs.sparkSession
    first = docs.select("text").mapInArrow(lean(_first(width)), _FIRST)
    by_gram, by_context = Window.partitionBy("h", "salt"), Window.partitionBy("h", "salt", "c")
    doc = F.col("flag") == DOC
    known = (
        first.withColumn("times", F.count("*").over(by_context))
        .withColumn("multi", ~doc & ((F.col("flag").bitwiseAND(MULTI) > 0) | (F.min("c").over(by_gram) != F.max("c").over(by_gram))))
        .withColumn("same", ~doc & ((F.col("flag").bitwiseAND(SAME) > 0) | (F.col("times") > 1)))
        .where(doc | F.col("multi") | F.col("same"))
        .select("h", "t", "place", "flag", "multi", "same")
    )
    known, _ = stored(known, "contexts")
    copies = known.where(doc & (F.col("place") >= width)).groupBy("t", "place").agg(F.count("*").alias("n")).where("n > 1")
    whole = copies.select("t", F.lit(0).cast("long").alias("start"), F.col("place").alias("stop"))
    start = F.shiftright("place", 8)
    same = known.where("same").select("t", start.alias("start"), (start + F.col("place").bitwiseAND(255) + width).alias("stop"))
    grams, _ = stored(known.where("multi").groupBy("h").agg(F.count("*").alias("n")), "grams")
    hot = grams.where(F.col("n") > HOT)
    n_hot = hot.count()
    # of grams that the second filter takes for hot ones, all are counted by windows
    shared = spark.sparkContext.broadcast((made_filter(grams, "h", grams.count()), made_filter(hot, "h", n_hot) if n_hot else None))
    folder = fresh_path(spark, "columns")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    strings = docs.select("text").mapInArrow(lean(_strings(shared, width)), _STRINGS)
    found = strings.repartition("h").sortWithinPartitions("h").mapInArrow(lean(_repeats(width, folder)), "t binary, start long, stop long")
    every = whole.unionByName(same).unionByName(found)
    if n_hot:
        windows = docs.select("text").mapInArrow(lean(_windows(shared, width)), _FIRST).withColumn("times", F.count("*").over(by_context))
        again = windows.where((F.col("flag") == SAME) | (F.col("salt") == 0) & (F.col("times") > 1))
        every = every.unionByName(again.select("t", start.alias("start"), (start + F.col("place").bitwiseAND(255) + width).alias("stop")))
    return every.repartition("t").sortWithinPartitions("t").mapInArrow(lean(_joined), "t binary, head long, spans binary")


def substring_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs(doc_id, text)``."""
    spans, _ = stored(repeated_spans(docs, width), "spans")
    losing = docs.sparkSession.sparkContext.broadcast(made_filter(spans, "head", spans.count()))
    texts = docs.select("text").mapInArrow(lean(_texts(losing)), "t binary, text binary")
    # a broadcast would put both Python steps into one stage
    cut = texts.join(spans.select("t", "spans").hint("merge"), "t").mapInArrow(lean(_cut), "t binary, n_removed long, n_spans long, kept string")
    # batches that have a text in common give equal rows
    cut, _ = stored(cut.dropDuplicates(["t"]), "cut")
    zero = F.lit(0).cast("long")
    return docs.select("doc_id", "text").mapInArrow(lean(_rows), _ROWS).join(cut, "t", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


OP1_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, md5(substr(h, 2 * i + 1, 400)) as g from (select doc_id, h, unnest(range(0, len(h) // 2 - 199)) as i from d)),
r as (select g from w group by g having count(*) > 1),
s as (select doc_id, i from w semi join r using (g)),
x as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 200 then 0 else 1 end as fresh from s),
y as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run from x),
z as (select doc_id, min(i) as a, max(i) + 200 as b from y group by doc_id, run),
p as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as c from z),
k as (select p.doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as e, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' order by a) as kept
  from p join d using (doc_id) group by p.doc_id)
select d.doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(case when e is null then h else kept || substr(h, 2 * e + 1) end)) as kept_sha256
from d left join k using (doc_id)
"""
