"""Expressions with hand-made results."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenforge.errors import ConfigError
from tokenforge.functions import bpe, json, primes, softlabel, text
from tokenforge.plans import protein


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ('{"text":"a","more":[1]}', "a"),
        ('["a"]', "a"),
        ('{"text":""}', ""),
        ('{"text":"é\\u00e9\\n"}', "éé\n"),
        ('{"text":null}', None),
        ('{"text":5}', None),
        ('{"other":"a"}', None),
        ('{"text":"a","text":"b"}', None),
        ('{"text":"a"} x', None),
        ('{"text":"a"', None),
        ('{"text":NaN}', None),
        ('{"text":"\\ud800"}', None),
        ('{"text":"\\ud83d\\ude00"}', "\U0001f600"),
        ('{"text":"a","n":' + "9" * 5000 + "}", "a"),
        ('{"text":"a","n":1e999}', "a"),
        ('{"text":1.5}', None),
        ("[]", None),
        ('["a","b"]', None),
        ("", None),
        (None, None),
        ('"a"', None),
    ],
)
def test_strict_text(spark, line, want):
    assert one(spark, line, lambda c: json.strict_text(c)) == want


@pytest.mark.parametrize(("line", "want"), [('{"text":"a"}', "a"), ('{"text":5}', None), ('{"text":{"a":1}}', None), ("x", None), ('{"t":"a"}', None)])
def test_native_text(spark, line, want):
    assert one(spark, line, json.text_field) == want


@pytest.mark.parametrize(("line", "want"), [("[1,65535,0]", [1, 65535, 0]), ("[65536]", None), ("[-1]", None), ("[1.5]", None), ('["1"]', None), ("[]", []), ("{}", None), ("x", None)])
def test_u16_tokens(spark, line, want):
    assert one(spark, line, json.u16_tokens) == want


def test_last_duplicate_key_wins(spark):
    json.allow_duplicate_keys(spark)
    assert one(spark, '{"a":1,"a":2}', lambda c: json.field(json.parsed(c), "a", "int")) == 2


@pytest.mark.parametrize(
    ("value", "f", "want"),
    [
        (" \t x　", text.trim, "x"),
        ("id some words ", text.header_id, "id"),
        ("id some words ", text.header_description, "some words"),
        ("id\tx", text.header_description, "x"),
        ("id", text.header_description, None),
        ("", text.header_id, ""),
        (" a\tb ", text.first_field, "a"),
        (" \t ", text.first_field, None),
        ("é", lambda c: F.octet_length(text.with_end(c)), 3),
        ("p:12", lambda c: text.key_number(c, "p:"), 12),
        ("p:+7", lambda c: text.key_number(c, "p:"), 7),
        ("p:-7", lambda c: text.key_number(c, "p:"), None),
        ("p:x", lambda c: text.key_number(c, "p:"), None),
        ("q:1", lambda c: text.key_number(c, "p:"), None),
        ("abcdefg", lambda c: text.wrapped(c, 3), "abc\ndef\ng"),
        ("abcdef", lambda c: text.wrapped(c, 3), "abc\ndef"),
        ("", text.characters, []),
        ("a\n\U0001f600", text.characters, ["a", "\n", "\U0001f600"]),
    ],
)
def test_text(spark, value, f, want):
    assert one(spark, value, f) == want


def test_fasta_record(spark):
    row = spark.createDataFrame([("i", "d e", "abcd"), ("j", None, ""), ("k", "", "a")], "id string, desc string, seq string")
    got = [r["x"] for r in row.select(text.fasta_record(F.col("id"), F.col("desc"), F.col("seq"), 3).alias("x")).collect()]
    assert got == [">i d e\nabc\nd", ">j", ">k\na"]


def test_byte_size():
    assert [text.byte_size(n) for n in (5, 2048, 3 << 20, 5 << 30)] == ["5 B", "2.00 KiB", "3.00 MiB", "5.00 GiB"]


def model(labels: dict) -> list[float]:
    known = {k: (0.002 if v == 0 else v) for k, v in labels.items()}
    for x in softlabel.LABELS[8:]:
        known.setdefault(x, 0.002)
    total, out = sum(known.values()), [0.0] * 39
    if total <= 0:
        return out
    for k, v in known.items():
        out[softlabel.LABELS.index(k) if k in softlabel.LABELS else 3] += v / total
    return out


@pytest.mark.parametrize("labels", [{"A": 1}, {"A": 0, "B": 0.5}, {"?": 0.3, "<unk>": 0.2}, {"<eos>": 1, "k": 2.5}, {"A": -5.0}, {"A": -0.06 + 0.0001}])
def test_vector(spark, labels):
    import json as j

    document = j.dumps({"softlabel_seq": [labels]})
    got = one(spark, document, lambda c: softlabel.flat_vectors(softlabel.positions(c)))
    assert got[:39] == pytest.approx(model(labels), abs=1e-5) and got[39:] == [1.0] + [0.0] * 38


@pytest.mark.parametrize(
    ("document", "want"),
    [
        ('{"softlabel_seq":[]}', []),
        ("{}", None),
        ("[1]", None),
        ('{"softlabel_seq":5}', None),
        ("x", None),
        ('{"softlabel_seq":[{"A":1,"B":"x"},7,null,{"C":2}]}', [{"A": 1.0}, None, None, {"C": 2.0}]),
    ],
)
def test_positions(spark, document, want):
    assert one(spark, document, softlabel.positions) == want


def test_no_positions_no_vector(spark):
    assert one(spark, '{"softlabel_seq":[]}', lambda c: softlabel.flat_vectors(softlabel.positions(c))) is None
    # a list of nothing but other values is not empty: it has the end vector
    assert one(spark, '{"softlabel_seq":[1,"x"]}', lambda c: softlabel.flat_vectors(softlabel.positions(c))) == [1.0] + [0.0] * 38
    df = spark.createDataFrame([(1, [None, None]), (2, []), (3, None), (4, [None, {"A": 1.0}])], "i int, l array<map<string,double>>")
    got = {r["i"]: r["v"] for r in softlabel.with_vectors(df, "l", "v").collect()}
    assert got[1] == [1.0] + [0.0] * 38 and len(got[4]) == 2 * 39 and got.keys() == {1, 4}
    assert {r["i"]: r["v"] is None for r in softlabel.with_vectors(df, "l", "v", keep_null=True).collect()} == {1: False, 3: True, 4: False}


def test_vocabulary_text():
    v = bpe.Vocabulary(["1 'a' 1", "2 b'\\xff' 1", "4 '\\n' 1", "junk", "5 'é' 2", '6 "it\'s" 4'])
    assert v.tokens == [b"\0", b"a", b"\xff", b"", b"\n", "é".encode(), b"it's"] and v.skipped == ["junk"] and len(v) == 7
    assert v.entries() == {"\0": 0, "a": 1, "[Binary token [255]]": 2, "\n": 4, "é": 5, "it's": 6}
    assert len(bpe.Vocabulary([])) == 1 and bpe.Vocabulary([" x 3 'ab' 2"]).tokens == [b"\0", b"", b"", b"ab"]
    assert bpe.Vocabulary([r"1 '\u00e9\x41\101\'' 5"]).tokens[1] == "éAA'".encode()
    for bad in ("1 'ab' 1", "70000 'a' 1", "1 b'\\xfg' 1", "1 b'\\xf' 1", r"1 '\q' 2", r"1 '\ud800' 3"):
        with pytest.raises(ConfigError):
            bpe.Vocabulary([bad])


def test_encoding_rules():
    v = bpe.Vocabulary(["1 'a' 1", "2 'ab' 2", "3 'abc' 3", "4 'b' 1", "5 'a' 1"])
    assert v.encode(b"abcaba") == [3, 2, 5, 0]
    assert v.encode(b"") == [0] and v.encode(b"", end=False) == []
    assert v.encode(b"abxab") == [2, 0]  # the first byte without a match ends the text
    assert v.decode([3, 99, 4]) == "abcb"


def test_decode_turns_encode_round(spark):
    r = random.Random(1)
    v = bpe.byte_vocabulary(["th", "the", " the", "é", "中"])
    texts = ["".join(r.choice("the é中\n\U0001f600") for _ in range(r.randint(0, 60))) for _ in range(200)] + [None]
    encode, decode = bpe.encoder(spark, v, end=False), bpe.decoder(spark, v)
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode(encode("t")).alias("back")).collect()
    assert all(r["t"] == r["back"] for r in got)
    rows = [[3, 99999, 257, -1], [], [256], None, [200, 201, 195 + 1]]
    got = spark.createDataFrame([(x,) for x in rows], "x array<int>").coalesce(1).select(decode("x").alias("t")).collect()
    assert [r["t"] for r in got] == [None if x is None else v.decode(x) for x in rows]


def test_magic_prime():
    assert primes.magic_prime(2473458, 512) == 4817
    assert primes.magic_prime(3 * 512, 512) == 0
    assert [i for i in range(30) if primes.is_prime(i)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29]


def test_vectors_by_batches_like_expressions(spark, monkeypatch):
    monkeypatch.setattr(softlabel, "POSITIONS", 3)
    r = random.Random(4)
    rows = [(i, [{r.choice([*softlabel.LABELS, "?", "é"]): r.choice([0.0, 0.25, 1.0, -9.0, 3.5]) for _ in range(r.randint(0, 5))} for _ in range(r.randint(0, 5))]) for i in range(60)]
    df = spark.createDataFrame([*rows, (60, None)], "i int, l array<map<string,double>>").repartition(2)
    want = {x["i"]: x["v"] for x in df.select("i", softlabel.flat_vectors(F.col("l")).alias("v")).collect() if x["v"] is not None}
    got = {x["i"]: x["v"] for x in softlabel.with_vectors(df, "l", "v").collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i], abs=1e-6)


def test_encoding_like_plain_greedy_search():
    r = random.Random(6)
    for _ in range(300):
        tokens = list({bytes(r.choice(b"abc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 8))})
        v = bpe.Vocabulary([f"{i + 1} b'{''.join(f'\\x{c:02x}' for c in t)}' {len(t)}" for i, t in enumerate(tokens)])
        raw, want, at = bytes(r.choice(b"abc") for _ in range(r.randint(0, 30))), [], 0
        while found := next((k for k in range(len(raw) - at, 0, -1) if raw[at : at + k] in tokens), 0):
            want.append(tokens.index(raw[at : at + found]) + 1)
            at += found
        assert v.encode(raw, end=False) == want


def test_settings(tmp_path):
    from tokenforge.config import load_toml
    from tokenforge.endpoints import KeyValue

    p = tmp_path / "a.toml"
    p.write_text('path = "/kv"\ndb = 2\n')
    assert load_toml(str(p)) == {"path": "/kv", "db": 2} and load_toml(str(p), KeyValue) == KeyValue("/kv", 2)
    p.write_text('path = "/kv"\nother = 1\n')
    with pytest.raises(ConfigError, match="other"):
        load_toml(str(p), KeyValue)
    with pytest.raises(ConfigError):
        load_toml(str(tmp_path / "none.toml"))


def test_tasks_of_vectors_do_not_grow_with_the_table(spark):
    """A task takes a share of the documents, however few splits or cores there are; also behind a shuffle."""
    docs = spark.range(0, 1 << 16, 1, 4).select(F.concat(F.lit('{"softlabel_seq":[{"A":1}],"n":'), "id", F.lit("}")).alias("value"))
    few = protein.vectors(docs.where("value is null or value > ''"))
    many = protein.vectors(docs.unionAll(docs).unionAll(docs).unionAll(docs))
    assert few.rdd.getNumPartitions() >= 12 and many.rdd.getNumPartitions() >= 3 * few.rdd.getNumPartitions()
    assert protein.vectors(docs.distinct()).rdd.getNumPartitions() >= 12
    assert few.count() == 1 << 16 and many.count() == 1 << 18


def test_slices():
    from tokenforge.functions.slices import slices

    texts = pa.array(["é" * 3, None, "", "x" * 50, "a", "b", "c"])
    assert [p.to_pylist() for p in slices(texts, 7)] == [["é" * 3, None, ""], ["x" * 50], ["a", "b", "c"]]
    assert [p.to_pylist() for p in slices(pa.array([[1], [2], None, [3, 4, 5]], pa.list_(pa.int32())), 8)] == [[[1], [2], None], [[3, 4, 5]]]
    assert [len(p) for p in slices(texts.slice(0, 0), 7)] == [0]


def test_workers_hold_a_slice_of_a_batch_at_a_time(spark):
    """Batches are as long as Spark makes them; what is made of them is not."""
    from tokenforge.functions.slices import SLICE

    v = bpe.byte_vocabulary(["the"])
    texts = pa.array(["over the hill " * 2000, None, "", "é"] * 40)
    ids = list(bpe.encoder(spark, v).func(iter([texts])))
    assert len(ids) > 3 and max(len(p.values) for p in ids) <= SLICE + 4 * 40
    assert [x for p in ids for x in p.to_pylist()] == [None if t is None else v.encode(t.encode()) for t in texts.to_pylist()]
    back = list(bpe.decoder(spark, v).func(iter([pa.concat_arrays(ids)])))
    assert len(back) > 3 and [x for p in back for x in p.to_pylist()] == [None if t is None else t + "\0" for t in texts.to_pylist()]
    lines = pa.array(['{"text":"' + "x" * 30_000 + '"}', "[1]", None] * 40)
    strict = list(json.strict_text.func(iter([lines])))
    assert len(strict) > 3 and [x for p in strict for x in p.to_pylist()] == ["x" * 30_000, None, None] * 40


def test_encode_all_is_like_encode():
    draw = random.Random(7)
    for _ in range(60):
        signs = bytes(draw.sample(range(256), draw.choice([2, 3, 8])))
        tokens = sorted({bytes(draw.choices(signs, k=draw.randint(1, 6))) for _ in range(draw.randint(0, 20))})
        v = bpe.Vocabulary([f"{i} b'{''.join(f'\\x{c:02x}' for c in t)}' {len(t)}" for i, t in enumerate(tokens)])
        texts = [bytes(draw.choices(signs + b"?", [9] * len(signs) + [draw.choice([0, 1])], k=draw.choice([0, 1, 5, 40]))) for _ in range(9)]
        for end in (True, False):
            ids, sizes = v.encode_all(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]), end)
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [v.encode(t, end) for t in texts]
