import public_tokenizers
import pytest

from tests.llm.cases import documents, frame, tuples
from tokenforge.llm import token_counts as C

SPECIAL = [(200, "<|endoftext|> a<|endoftext|>"), (201, "don't  I'll\r\n\n x 　 中文 \U0001f600"), (202, "ǆ" * 30), (203, "\x1c \x85 \xa0")]


def library(name):
    if name.endswith(".model"):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return lambda t: len(m.encode(t))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda x: len(t.encode(x, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_as_the_library(spark, tmp_path, name):
    rows = documents() + SPECIAL
    count = library(name)
    want = []
    for i, t in rows:
        n = count(t or "")
        want.append((i, len((t or "").encode()), n, n > 512))
    got = C.token_counts(frame(spark, rows), public_tokenizers.path(name), f"file://{tmp_path}/cache")
    assert tuples(got) == sorted(want, key=repr)


def test_cache_is_used_and_appended(spark, tmp_path):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/cache"
    assert tuples(C.token_counts(frame(spark, [(1, "a b"), (2, "a b"), (3, "c")]), path, cache)) == [(1, 3, 2, False), (2, 3, 2, False), (3, 1, 1, False)]
    assert spark.read.parquet(cache).count() == 2
    C.token_counts(frame(spark, [(1, "a b"), (4, "d e f")]), path, cache).collect()
    assert spark.read.parquet(cache).count() == 3
    # a stored count is taken as it is
    spark.read.parquet(cache).selectExpr("digest", "n_tokens + 100 as n_tokens", "tokenizer").write.parquet(f"{cache}2")
    assert tuples(C.token_counts(frame(spark, [(3, "c")]), path, f"{cache}2")) == [(3, 1, 101, False)]


@pytest.mark.parametrize("few", [0, 1000])
def test_few_and_many_misses_alike(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(C, "FEW", few)
    path, cache, rows = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/cache", documents()
    first = tuples(C.token_counts(frame(spark, rows[:30]), path, cache))
    held = spark.read.parquet(cache).count()
    every = tuples(C.token_counts(frame(spark, rows), path, cache))
    assert set(first) <= set(every) and held < spark.read.parquet(cache).count() == len({t or "" for _, t in rows})
    count = library("byte_bpe_50k.json")
    assert every == sorted(((i, len((t or "").encode()), count(t or ""), count(t or "") > 512) for i, t in rows), key=repr)


def test_registered_query(spark, sf):
    count = library("byte_bpe_50k.json")
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert tuples(C.op6_token_counts(spark, sf)) == sorted(((i, len(t.encode()), count(t), count(t) > 512) for i, t in rows), key=repr)


def test_empty_table(spark, tmp_path):
    assert tuples(C.token_counts(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/cache")) == []
