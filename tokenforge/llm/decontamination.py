"""Benchmark decontamination with a generalised suffix automaton (operator 3).

Test items, as words of lower-cased text, are put into one suffix automaton.  Training tokens stream through it and
the length of the longest match ending at each word is tracked.  Where it reaches ``window`` words the last
``window`` words are hit; an item of fewer words is hit where it occurs as a whole.  Only stretches of words whose
neighbouring pairs all occur in items are streamed, as no match can be longer than its stretch.

The items' side is dealt out over automata of about ``SLICE_WORDS`` words (or one longer item).  Tasks build them and write
each to a file in the shared folder; the driver sees their paths only.  A worker keeps KEPT loaded, and takes each through
all of BLOCK bytes of documents before the next is loaded, so its memory grows neither with the items nor with the
documents.  Documents are not shuffled.

Defined cases: null and empty texts have no words and no hits; empty items are ignored; items with a null id hit
words but are not counted; items with equal ids count once; no items, no hits; rows repeat as in the input;
other columns are ignored by the report and kept by the removal.
"""

from __future__ import annotations

import gc
import hashlib
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .shared import fresh_path, spread, table

WINDOW = 10
#: Words of items in one automaton, about.
SLICE_WORDS = 200_000
#: Bytes of texts that automata are taken through in turn, and automata that a worker keeps loaded.
BLOCK, KEPT = 1 << 24, 2


def words_of(text: str | None) -> list[bytes]:
    """The words of one text."""
    buf = np.frombuffer((text or "").encode(), np.uint8)
    low = tk.LOWER[buf]
    starts, ends, _ = tk.word_spans(low, np.array([0, len(buf)]), tk.ALNUM)
    raw = low.tobytes()
    return [raw[s:e] for s, e in zip(starts, ends, strict=True)]


class Automaton:
    """A generalised suffix automaton over the words of items ``(item_id, words)``."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.words = sorted({w for _, ws in items for w in ws})
        ids = {w: i for i, w in enumerate(self.words)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.own: list[set | None] = [None]
        self.whole: dict[int, list[tuple[int, object]]] = {}  # state -> short items that end there
        pairs = set()
        self.least = window
        for item, ws in items:
            if not ws:
                continue
            seq = [ids[w] for w in ws]
            pairs.update(a * len(self.words) + b for a, b in zip(seq, seq[1:], strict=False))
            last = 0
            for c in seq:
                last = self._extend(last, c)
                self.own[last] = (self.own[last] or set()) | {item}
            if len(seq) < window:
                self.whole.setdefault(last, []).append((len(seq), item))
                self.least = min(self.least, len(seq))
        self.pairs = np.array(sorted(pairs), np.int64)
        # whether a short item ends at a state or at a suffix of it
        self.ends = [False] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.ends[s] = s in self.whole or self.ends[self.link[s]]
        self.below: list[list[int]] = [[] for _ in self.len]
        for s in range(1, len(self.len)):
            self.below[self.link[s]].append(s)
        joined = b" ".join(self.words)
        buf = np.frombuffer(joined, np.uint8)
        lengths = np.array([len(w) for w in self.words], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        hashes = tk.Hasher().spans(buf, ends - lengths, ends) if self.words else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int64)
        self.memo: dict[int, frozenset] = {}

    def _state(self, length: int, link: int, following: dict[int, int], own: set | None) -> int:
        self.next.append(following)
        self.len.append(length)
        self.link.append(link)
        self.own.append(own)
        return len(self.len) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]), None)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, c, q)
        new = self._state(self.len[last] + 1, 0, {}, None)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
        return new

    def items_at(self, state: int) -> frozenset:
        """Items in which the strings of ``state`` occur."""
        if state not in self.memo:
            found, todo = set(), [state]
            while todo:
                s = todo.pop()
                if s in self.memo:
                    found |= self.memo[s]
                    continue
                found |= self.own[s] or set()
                todo += self.below[s]
            self.memo[state] = frozenset(found)
        return self.memo[state]

    def stream(self, seq: list[int], hit: np.ndarray, at: int) -> set:
        """Stream ``seq``; mark hit words in ``hit`` from ``at`` on; return the items hit."""
        nxt, link, length, window = self.next, self.link, self.len, self.window
        state = matched = 0
        found: set = set()
        for j, c in enumerate(seq):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c not in nxt[state]:
                matched = 0
                continue
            state = nxt[state][c]
            matched += 1
            if matched >= window:
                hit[at + j + 1 - window : at + j + 1] = True
                u = state
                while length[link[u]] >= window:
                    u = link[u]
                found |= self.items_at(u)
            u = state
            while u > 0 and self.ends[u]:
                for m, item in self.whole.get(u, ()):
                    if m <= matched:
                        hit[at + j + 1 - m : at + j + 1] = True
                        found.add(item)
                u = link[u]
        return found

    def mark(self, low: np.ndarray, starts, ends, rows, hashes, hit: np.ndarray, found: dict[int, set]) -> None:
        """Mark hits among the words of a slice; ``found`` gets the items by row."""
        n = len(starts)
        if not n or not self.words:
            return
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ids = np.where(self.hashes[at] == hashes, self.ids[at], -1)
        known = ids >= 0
        both = np.flatnonzero(known[1:] & known[:-1] & (rows[1:] == rows[:-1]))
        code = ids[both] * len(self.words) + ids[both + 1]
        if len(self.pairs):
            p = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            both = both[self.pairs[p] == code]
        else:
            both = both[:0]
        tied = np.zeros(n + 1, bool)  # word i goes on to word i + 1
        tied[both] = True
        begin = np.flatnonzero(known & ~np.concatenate(([False], tied[: n - 1])))
        end = np.flatnonzero(known & ~tied[:n]) + 1
        raw = None
        for b, e in zip(begin, end, strict=True):
            if e - b < self.least:
                continue
            raw = low.tobytes() if raw is None else raw
            seq = ids[b:e].tolist()
            # equal hashes are not proof: a word that differs breaks the stretch
            for k, c in enumerate(seq):
                if raw[starts[b + k] : ends[b + k]] != self.words[c]:
                    seq[k] = -1
            items = self.stream(seq, hit, b)
            if items:
                found.setdefault(int(rows[b]), set()).update(items)


def _built(folder: str, window: int):
    """Writes the automaton of a partition of items to a file, and gives its path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = []
        for b in batches:
            for item, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ws = words_of(t)
                if ws:
                    items.append((item, ws))
        if not items:
            return
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = uuid.uuid4().hex
        with fs.open_output_stream(f"{base}/{name}") as out:
            out.write(pickle.dumps(Automaton(items, window)))
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})

    return run


def automata(items: DataFrame, window: int = WINDOW) -> list[str]:
    """Paths of automata over ``items(item_id, text)``: one for every SLICE_WORDS words or so, built by tasks."""
    spark = items.sparkSession
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0]["n"] or 0
    parts = -(-size // (6 * SLICE_WORDS)) or 1  # words with what is between them take six bytes or more
    folder = fresh_path(spark, "automata")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    laid = items.select("item_id", "text").where("text is not null").repartition(parts)
    return sorted(r["path"] for r in laid.mapInArrow(_built(folder, window), "path string").collect())


_LOADED: dict[str, Automaton] = {}


def _load(path: str) -> Automaton:
    if path not in _LOADED:
        while len(_LOADED) >= KEPT:
            del _LOADED[next(iter(_LOADED))]
        fs, base = pafs.FileSystem.from_uri(path)
        with fs.open_input_stream(base) as f:
            raw = f.read()
        gc.disable()  # many small objects: collections would walk them again and again
        try:
            _LOADED[path] = pickle.loads(raw)
        finally:
            gc.enable()
    return _LOADED[path]


def _hits(column: pa.Array, paths: list[str]) -> Iterator[tuple]:
    """For each row: (number of words, hit mask, word starts and ends in the row's bytes, items)."""
    buf, off = tk.flat(column)
    hasher = tk.Hasher()
    for first, last in tk.slices(off, BLOCK):
        held = []
        for a, b in tk.slices(off[first : last + 1]):
            a, b = a + first, b + first
            low, own = tk.LOWER[buf[off[a] : off[b]]], off[a : b + 1] - off[a]
            starts, ends, rows = tk.word_spans(low, own, tk.ALNUM)
            held.append((b - a, own, low, starts, ends, rows, hasher.spans(low, starts, ends), np.zeros(len(starts), bool), {}))
        # the one that the last block ended with is loaded still
        paths.sort(key=lambda p: p not in _LOADED)
        for path in paths:
            automaton = _load(path)
            for _, _, *words, found in held:
                automaton.mark(*words, found)
        for n, own, _, starts, ends, rows, _, hit, found in held:
            edges = np.searchsorted(rows, np.arange(n + 1))
            for i in range(n):
                s = slice(edges[i], edges[i + 1])
                yield hit[s], starts[s] - own[i], ends[s] - own[i], found.get(i, ())


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row for each row of ``docs(doc_id, text)``: words, hit words and the items that have occurring windows."""
    paths = automata(items, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(paths)
        for b in batches:
            words, hits, n_items, digests = [], [], [], []
            for hit, _, _, found in _hits(b.column("text"), own):
                names = sorted(str(x) for x in found if x is not None)
                words.append(len(hit))
                hits.append(int(hit.sum()))
                n_items.append(len(names))
                digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("contaminated", F.col("n_hit") > 0)


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = 0.5) -> DataFrame:
    """``docs`` without hit spans; a document with more than ``coverage`` of its words hit is dropped whole.

    A removed span reaches from its first word to its last; ``n_chars`` (where present) follows the text.
    """
    paths = automata(items, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(paths)
        for b in batches:
            column, names = b.column("text"), b.schema.names
            keep, changed = np.ones(b.num_rows, bool), {}
            for i, (hit, starts, ends, _) in enumerate(_hits(column, own)):
                if not hit.any():
                    continue
                if hit.sum() > coverage * len(hit):
                    keep[i] = False
                    continue
                raw, out, at = column[i].as_py().encode(), [], 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                for s, e in zip(edge[::2], edge[1::2], strict=True):
                    out.append(raw[at : starts[s]])
                    at = ends[e - 1]
                changed[i] = b"".join([*out, raw[at:]]).decode()
            if changed:
                texts = column.to_pylist()
                lengths = b.column("n_chars").to_pylist() if "n_chars" in names else None
                for i, t in changed.items():
                    texts[i] = t
                    if lengths:
                        lengths[i] = len(t)
                k = names.index("text")
                b = b.set_column(k, b.schema.field(k), pa.array(texts, b.schema.field(k).type))
                if lengths:
                    k = names.index("n_chars")
                    b = b.set_column(k, b.schema.field(k), pa.array(lengths, b.schema.field(k).type))
            yield b if keep.all() else b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
k as (select distinct item_id, g, len(g) as m from (
  select item_id, unnest(case when len(w) >= 10 then list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) when len(w) > 0 then [w] else [] end) as g from b)),
m as (select distinct m from k),
p as (select doc_id, m, i, w[i:i + m - 1] as g from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, m)),
h as (select p.doc_id, p.i, p.m, k.item_id from p join k on p.g = k.g),
n as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + m)) as j from h) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as s from (select distinct doc_id, item_id::varchar as item_id from h) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n.n_hit, 0)::bigint as n_hit, coalesce(t.n_items, 0)::bigint as n_items,
  sha256(coalesce(t.s, '')) as items_sha256, coalesce(n.n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""
