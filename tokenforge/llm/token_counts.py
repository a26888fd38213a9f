"""Token counts through a digest cache (operator 6).

Content digests and the tokenizer's version digest are joined to a stored table of counts, before any text is moved; texts
whose digest is missing are made distinct, encoded once, and appended to that table; a last join gives every row its
count.  While at most FEW digests are missing they are broadcast, so with a warm cache only those texts are shuffled.

Defined cases: a null text counts as the empty text (0 bytes, 0 tokens); repeated rows each get a row; an empty
table gives an empty result; other columns of the input are ignored; the normalisation of the content is only
that null becomes empty, as any other would change counts.  Special strings inside texts are handled as the
library does by default: each is one token.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import dropped, fresh_path, spread, stored, table

#: Missing digests that are broadcast at most: 32 bytes each.
FEW = 100_000
#: Texts of these characters only, whose classes are the same in every Unicode version, take the fast path.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ]*")
_LONG = re.compile(r"\S{4000}|\s{4000}")
#: The byte-level pre-tokenizer's pattern (fixed value).
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def version_digest(path: str) -> str:
    """The digest that stands for a tokenizer's version: of its file's bytes."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


def _ranked(spec: dict):
    """A rank-merging encoder with the results of a plain byte-level BPE, or None where the two could differ.

    Both merge the pair of lowest rank first; ids that grow along the list of merges make ids ranks.
    """
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    if (
        any(spec.get(k) is not None for k in ("normalizer", "truncation", "padding"))
        or pre.get("type") != "ByteLevel"
        or not pre.get("use_regex", True)
        or pre.get("add_prefix_space")
        or model.get("type") != "BPE"
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    ):
        return None
    symbols, vocab = _byte_symbols(), model["vocab"]
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocab.get("".join(m), -1) for m in merged]
    if any(b <= a for a, b in zip(ids, ids[1:], strict=False)) or any(c not in vocab for c in symbols):
        return None
    if max(vocab[c] for c in symbols) >= min(ids, default=256):
        return None
    import tiktoken

    ranks = {bytes(symbols[c] for c in t): vocab[t] for t in [*symbols, *("".join(m) for m in merged)]}
    return tiktoken.Encoding("ranked", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


class Counter:
    """Counts tokens as the vocabulary's library does.

    A plain byte-level BPE is run through a faster encoder of the same merges for texts of plain characters.
    Texts with other characters, very long pieces or added tokens' strings, and all other tokenizers, go to the
    library itself.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.ranked, self.added = None, []
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        self.library = lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.ranked = _ranked(spec)

    def __call__(self, texts: list[str]) -> list[int]:
        if self.ranked is None:
            return self.library(texts)
        out, whole = [0] * len(texts), []
        for i, t in enumerate(texts):
            if _PLAIN.fullmatch(t) and not any(a in t for a in self.added) and not _LONG.search(t):
                out[i] = len(self.ranked.encode_ordinary(t))
            else:
                whole.append(i)
        for i, n in zip(whole, self.library([texts[i] for i in whole]) if whole else [], strict=True):
            out[i] = n
        return out


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for b in batches:
            column, done, start = b.column("text"), [], 0
            while start < b.num_rows:  # as Python strings, a few at a time
                done += count([t or "" for t in column.slice(start, 256).to_pylist()])
                start += 256
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(done, pa.int64())], names=["digest", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs(doc_id, text)``.

    ``tokenizer`` is the vocabulary's file (.json or .model), on every executor; ``cache`` the path of the table of
    counts in storage that all executors share.  The misses are written there before the result is read, so a lost
    executor costs only its own tasks.  Two writers may append the same digest; readers take it once.
    """
    spark = docs.sparkSession
    version = version_digest(tokenizer)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    schema = "digest binary, n_tokens long, tokenizer string"

    def cached() -> DataFrame:
        try:
            held = spark.read.schema(schema).parquet(cache)
        except Exception as e:  # no cache yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            held = spark.createDataFrame([], schema)
        return held.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    missing, missing_path = stored(keyed.select("digest").distinct().join(cached(), "digest", "left_anti"), "token-misses")
    n, texts = missing.count(), keyed.select("digest", "text")
    if n <= FEW:
        misses = texts.join(F.broadcast(missing), "digest", "left_semi").dropDuplicates(["digest"])
    else:
        misses = texts.dropDuplicates(["digest"]).join(missing, "digest", "left_semi")
    new = misses.mapInArrow(_encode(tokenizer), "digest binary, n_tokens long")
    new.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache)
    dropped(spark, missing_path)
    # stored once more, so that the join's sides are plain exchanges whose hot digests can be split
    counts, _ = stored(cached(), "token-counts")
    return (
        keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
        .join(counts, "digest", "left")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), path, fresh_path(spark, "token-count-cache"))


def token_count_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of the counts' rows: a row for each document with its bytes."""
    return op6_token_counts(spark, sf_dir).select("doc_id", "n_bytes", (F.col("n_tokens") <= F.col("n_bytes")).alias("at_most_bytes"))


TOKEN_BYTES_SQL = "select doc_id, strlen(coalesce(text, ''))::bigint as n_bytes, true as at_most_bytes from documents"
