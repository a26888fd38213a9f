"""Longest-match tokenizer over bytes: vocabulary text, encoding and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConfigError
from .slices import slices

# Fixed values of the vocabulary format: the grammar of a line and the text that stands in for other bytes.
_LINE = re.compile(r"(\d+)\s+(b?)(.+)\s+(\d+)")
_BINARY = "[Binary token {}]"
_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "'": "'", '"': '"', "\\": "\\"}
_ESCAPE = re.compile(r"""\\(?:([bfnrt'"\\])|u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|([0-3][0-7]{0,2}|[4-7][0-7]?)|)""")
#: Appended to encoded documents.
END_ID = 0
MOST_ID = 65535


def _unescaped(text: str) -> bytes:
    def one(m: re.Match) -> str:
        plain, long, octal = m[1], m[2] or m[3], m[4]
        if plain:
            return _ESCAPES[plain]
        if not long and not octal:
            raise ConfigError(f"a bad escape in {text!r}")
        return chr(int(long, 16) if long else int(octal, 8))

    try:
        return _ESCAPE.sub(one, text).encode()
    except UnicodeEncodeError as e:
        raise ConfigError(f"half a character in {text!r}") from e


def _hex(text: str) -> bytes:
    digits = text.replace("\\x", "")
    if len(digits) % 2 or not re.fullmatch("[0-9a-fA-F]*", digits):
        raise ConfigError(f"bad hex in {text!r}")
    return bytes.fromhex(digits)


class Vocabulary:
    """Tokens by id, from lines ``id 'token' length`` or ``id b'\\xNN' length``.

    Lines that do not parse are kept in ``skipped``; bad hex, a bad escape, a wrong length or an id beyond 16 bits is an
    error.  Gaps are empty.  Of lines with one id the last names the token, but all of them are matched.
    """

    def __init__(self, lines: list[str]) -> None:
        self.skipped: list[str] = []
        found: dict[int, bytes] = {0: b"\0"}  # the end of a document
        self._ids: dict[bytes, int] = {}
        for line in lines:
            m = _LINE.search(line.rstrip("\r\n"))
            if not m:
                self.skipped.append(line)
                continue
            number, binary, quoted, length = int(m[1]), m[2], m[3], int(m[4])
            if len(quoted) < 2:
                raise ConfigError(f"token {number} has no quotes")
            token = _hex(quoted[1:-1]) if binary else _unescaped(quoted[1:-1])
            if len(token) != length:
                raise ConfigError(f"token {number} has {len(token)} bytes, not {length}")
            if number > MOST_ID:
                raise ConfigError(f"id {number} does not fit 16 bits")
            found[number] = token
            self._ids[token] = number
        self.tokens = [found.get(i, b"") for i in range(max(found) + 1)]
        self._matcher = self._bytes = self._trie = None

    def __len__(self) -> int:
        return len(self.tokens)

    def entries(self) -> dict[str, int]:
        """Token text to id; bytes that are no text are shown as a list of numbers, empty tokens are left out."""
        out: dict[str, int] = {}
        for i, t in enumerate(self.tokens):
            if t:
                try:
                    out[t.decode()] = i
                except UnicodeDecodeError:
                    out[_BINARY.format(list(t))] = i
        return out

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_matcher": None, "_bytes": None, "_trie": None}  # workers build their own

    def _match(self):
        """Leftmost longest matches over bytes seen as Latin-1.  Id 0 ends no match; of equal tokens the last id wins."""
        if self._matcher is None:
            self._matcher = ahocorasick.Automaton()
            for t, i in self._ids.items():
                if i and t:
                    self._matcher.add_word(t.decode("latin-1"), (i, len(t)))
            self._matcher.make_automaton()
        return self._matcher

    def encode(self, raw: bytes, end: bool = True) -> list[int]:
        """Ids of the longest matches one after the other; the first byte without a match ends the text."""
        out, at = [], 0
        if raw and any(t and i for t, i in self._ids.items()):
            for last, (i, size) in self._match().iter_long(raw.decode("latin-1")):
                if last - size + 1 != at:
                    break
                out.append(i)
                at = last + 1
        if end:
            out.append(END_ID)
        return out

    def _states(self) -> tuple[np.ndarray, ...]:
        """The trie of the tokens: states after one byte, edges (state times 256 and byte, sorted; one that is none ends them), the
        edges' states, each state's id or 0, and whether edges leave it."""
        if self._trie is None:
            edges: dict[int, int] = {}
            ids = [0]
            for t, i in self._ids.items():
                if i and t:
                    at = 0
                    for byte in t:
                        key = at << 8 | byte
                        at = edges.get(key, 0)
                        if not at:
                            at = edges[key] = len(ids)
                            ids.append(0)
                    ids[at] = i
            keys = np.array(sorted(edges), np.int64)
            inner = np.zeros(len(ids), bool)
            inner[keys >> 8] = True
            first = np.array([edges.get(b, 0) for b in range(256)], np.int32)
            ends = np.array([*(edges[k] for k in keys.tolist()), 0], np.int32)
            self._trie = first, np.append(keys, np.iinfo(np.int64).max), ends, np.array(ids, np.int32), inner
        return self._trie

    def encode_all(self, raw: np.ndarray, ends: np.ndarray, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts, laid end to end in ``raw`` up to ``ends``, and each text's number of ids; as :meth:`encode`.

        The longest match at each byte is found at once; only those of more than one byte are then gone through in turn.
        """
        first, keys, states, ids, inner = self._states()
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        stop = np.repeat(ends, ends - starts)
        state = first[raw]
        best = ids[state]
        long = (best > 0).astype(np.int32)
        at, depth = np.flatnonzero(inner[state] & (state > 0)), 1
        state = state[at]
        while len(at):
            inside = at + depth < stop[at]
            at, state = at[inside], state[inside]
            key = state.astype(np.int64) << 8 | raw[at + depth]
            edge = np.searchsorted(keys, key)
            there = keys[edge] == key
            at, state, depth = at[there], states[edge[there]], depth + 1
            token = ids[state]
            whole = token > 0
            best[at[whole]], long[at[whole]] = token[whole], depth
            further = inner[state]
            at, state = at[further], state[further]
        over = np.flatnonzero(long != 1)
        step = np.where(long[over] > 0, long[over], stop[over] - over)  # without a match the text ends
        edges, done, heads, tails = np.zeros(len(raw) + 1, np.int8), 0, [], []
        for p, k in zip(over.tolist(), step.tolist(), strict=True):
            if p >= done:
                done = p + k
                heads.append(p + 1)
                tails.append(done)
        edges[heads] += 1
        edges[tails] -= 1
        taken = (np.cumsum(edges[:-1], dtype=np.int8) == 0) & (long > 0)
        sizes = np.diff(np.concatenate(([0], np.cumsum(taken)))[np.concatenate(([0], ends))])
        found = best[taken]
        if not end:
            return found, sizes
        out = np.full(len(found) + len(sizes), END_ID, np.int32)
        out[np.arange(len(found)) + np.repeat(np.arange(len(sizes)), sizes)] = found
        return out, sizes + 1

    def decode(self, ids: list[int]) -> str:
        """Text of ids; unknown ones are skipped and bytes that are no text replaced."""
        tokens, n = self.tokens, len(self.tokens)
        return b"".join([tokens[i] for i in ids if 0 <= i < n]).decode("utf-8", "replace")

    def decode_all(self, flat: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of many rows of ids, laid end to end in ``flat``: bytes are gathered at once from the tokens' bytes."""
        if self._bytes is None:
            own = np.array([len(t) for t in self.tokens] + [0], np.int64)
            self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8), np.concatenate(([0], np.cumsum(own)[:-1])), own
        data, starts, lengths = self._bytes
        n = len(self.tokens)
        at = np.where((flat >= 0) & (flat < n), flat, n)
        long = lengths[at]
        ends = np.concatenate(([0], np.cumsum(long)))
        place = np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[at], long)
        raw = data[place].tobytes()
        edges = ends[np.concatenate(([0], np.cumsum(sizes)))]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(token, id)`` of the vocabulary."""
        return spark.createDataFrame(list(self.entries().items()), "token string, id int")


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """The vocabulary of a text file in any storage that Spark reads; ids of 16 bits bound its entries."""
    return Vocabulary([r["value"] for r in spark.read.text(path, lineSep="\n").collect()])


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column and each row's end in them; nulls are empty."""
    rows = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = rows.buffers()
    off = np.frombuffer(offsets, np.int64)[rows.offset : rows.offset + len(rows) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off[1:] - off[0]


def encoder(spark: SparkSession, vocabulary: Vocabulary, end: bool = True):
    """A function from a text column to token ids."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = shared.value
        for column in texts:
            for part in slices(column):
                raw, ends = _flat(part)
                ids, sizes = v.encode_all(raw, ends, end)
                edges = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.ListArray.from_arrays(edges, pa.array(ids), mask=part.is_null())

    return encode


def decoder(spark: SparkSession, vocabulary: Vocabulary):
    """A function from a column of token ids to text."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf(T.StringType())
    def decode(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = shared.value
        for column in ids:
            for part in slices(column):
                flat = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.array([t if there else None for t, there in zip(v.decode_all(flat, sizes), part.is_valid().to_pylist(), strict=True)], pa.string())

    return decode


def byte_vocabulary(merges: list[str] = ()) -> Vocabulary:
    """All single bytes under the ids 1 to 256, then ``merges``."""
    lines = [f"{b + 1} b'\\x{b:02x}' 1" for b in range(256)]
    return Vocabulary(lines + [f"{257 + i} {m!r} {len(m.encode())}" for i, m in enumerate(merges)])
