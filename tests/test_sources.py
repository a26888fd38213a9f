"""Files of all kinds, there and back."""

import struct

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tokenforge.endpoints import Debug, Fasta, Fastq, Jdbc, KeyValue, Lines, TokenFile, TokenUnit, Xml
from tokenforge.errors import ComponentError, ConfigError, UnsupportedEndpointError
from tokenforge.operators import ids, keyed
from tokenforge.operators.pipeline import chain, run, sink, source
from tokenforge.plans import protein
from tokenforge.plans import text as plans
from tokenforge.sinks.files import write_fasta
from tokenforge.sources.fasta import read_fasta, read_fastq
from tokenforge.sources.lines import read_lines
from tokenforge.sources.tokenfile import line_count, read_tokens, write_tokens
from tokenforge.sources.xml import plain_xml, read_xml, record_texts
from tokenforge.streaming.pipeline import stream_lines, stream_to, stream_upserts


def put(path, content):
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_lines(spark, tmp_path):
    p = put(tmp_path / "a.txt", b"one\r\n\ntwo\rtwo\nlast \xff")
    assert [r["content"] for r in read_lines(spark, p).collect()] == ["one", "", "two\rtwo", "last �"]
    assert [r["content"] for r in read_lines(spark, p, limit=2).collect()] == ["one", ""]
    with pytest.raises(PySparkException):
        read_lines(spark, str(tmp_path / "none")).collect()
    assert read_lines(spark, str(tmp_path / "none"), missing="empty").count() == 0


@pytest.mark.parametrize("size", [37, 100, 4096])
def test_no_line_is_lost_between_splits(spark, tmp_path, size):
    p = put(tmp_path / "a.txt", "".join(f"line {i} {'x' * (i % 50)}\n" for i in range(500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        assert sorted(int(r["content"].split()[1]) for r in read_lines(spark, p).collect()) == list(range(500))
        assert [int(r["content"].split()[1]) for r in read_lines(spark, p, limit=123).collect()] == list(range(123))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_fasta(spark, tmp_path):
    put(tmp_path / "a.1.fa", ">i one two\nAC\nGT\n>j\tx\r\nAA\r\n> no id\nC\n>k\n")
    put(tmp_path / "a.2.fa", ">l\nTT")
    got = {(r["id"], r["desc"], r["seq"]) for r in read_fasta(spark, str(tmp_path / "a.*.fa")).collect()}
    assert got == {("i", "one two", "ACGT"), ("j", "x", "AA"), ("", "no id", "C"), ("k", None, ""), ("l", None, "TT")}
    assert read_fasta(spark, str(tmp_path / "none.*.fa"), missing="empty").count() == 0
    put(tmp_path / "b.1.fa", "garbage line\nmore\n>i\nAC\n>j\nGT\n")
    put(tmp_path / "b.2.fa", ">k\nAA\n")
    put(tmp_path / "b.3.fa", "no record")
    put(tmp_path / "b.4.fa", "")
    got = {(r["id"], r["desc"], r["seq"]) for r in read_fasta(spark, str(tmp_path / "b.*.fa")).collect()}
    assert got == {("i", None, "AC"), ("j", None, "GT"), ("k", None, "AA")}


def test_fasta_round_trip_and_fastq(spark, tmp_path):
    rows = [(f"i{k}", None if k % 3 else f"d {k}", "ACGT" * (k * 7 % 40)) for k in range(50)]
    write_fasta(spark.createDataFrame(rows, "id string, desc string, seq string"), str(tmp_path / "f"))
    assert sorted(map(tuple, read_fasta(spark, str(tmp_path / "f")).collect()), key=repr) == sorted(rows, key=repr)
    p = put(tmp_path / "q.fq", "@a x\nAC\n+\nII\n@b\nGG\n+\n@@\n")
    assert sorted(map(tuple, read_fastq(spark, p).collect())) == [("a", "x", "AC"), ("b", None, "GG")]
    many = "".join(f"@r{k} d\n{'ACGT' * (k % 9)}\n+\n@{k}\n" for k in range(300))
    put(tmp_path / "q2.fq", many)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = list(map(tuple, source(spark, Fastq(str(tmp_path / "q*.fq"))).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got, key=str) == sorted([("a", "x", "AC"), ("b", None, "GG")] + [(f"r{k}", "d", "ACGT" * (k % 9)) for k in range(300)], key=str)


def test_xml(spark, tmp_path):
    p = put(tmp_path / "a.xml", '<r><record id="1"><a>x &amp; y</a><b><![CDATA[<z>]]></b></record><record/><!-- <record>n</record> --><record><a> q </a></record></r>')
    assert sorted(map(tuple, read_xml(spark, p, schema="a string, b string").collect()), key=repr) == [("q", None), ("x & y", "<z>")]
    texts = spark.read.text(p, wholetext=True).select(F.explode(record_texts(F.col("value"))).alias("x"))
    want = ["<record><a>x &amp; y</a><b>&lt;z&gt;</b></record>", "<record><a>q</a></record>"]
    assert [r["x"] for r in texts.select(plain_xml("x").alias("x")).collect()] == want
    assert [r["content"] for r in source(spark, Xml(p, as_text=True)).collect()] == want


def test_missing_sources_are_empty_or_errors(spark, tmp_path):
    none = str(tmp_path / "none")
    specs = [Lines(none), Fasta(none), Fastq(none), Xml(none), Xml(none, as_text=True), KeyValue(none), TokenFile(none, "x"), TokenFile(none, "x", devices=None)]
    specs.append(Jdbc("jdbc:derby:memory:nothing;create=true", "NOTHING", "org.apache.derby.iapi.jdbc.AutoloadedDriver"))
    for spec in specs:
        assert source(spark, spec, "empty").count() == 0
        with pytest.raises(Exception):  # noqa: B017
            source(spark, spec).count()


def golden(rows, unit, units, legacy):
    fmt = {TokenUnit.U8: "B", TokenUnit.U16: "H", TokenUnit.F32: "f"}[unit]
    body = b"".join(struct.pack(f"<{len(r)}{fmt}", *r) for r in rows)
    counts = [len(r) // units for r in rows]
    offsets = np.cumsum([0] + [c * units * struct.calcsize(fmt) for c in counts]).tolist()
    head = b"MMIDIDX\0\0" + (struct.pack("<QB", 1, 8) if legacy else struct.pack("<QBI", 2, {"B": 0, "H": 1, "f": 2}[fmt], units))
    index = head + struct.pack("<QQ", len(rows), len(rows) + 1) + struct.pack(f"<{len(rows)}I", *counts)
    return body, index + struct.pack(f"<{len(rows) + 1}Q", *offsets) + struct.pack(f"<{len(rows) + 1}Q", *range(len(rows) + 1))


@pytest.mark.parametrize(
    ("unit", "units", "legacy", "rows"),
    [
        (TokenUnit.U16, 1, True, [[1, 65535], [], [7]]),
        (TokenUnit.U16, 2, False, [[1, 2, 3, 4], [0, 65535]]),
        (TokenUnit.U8, 1, False, [[0, 255], [3]]),
        (TokenUnit.F32, 3, False, [[0.5, -1.0, 2.0], []]),
        (TokenUnit.U16, 1, False, []),
    ],
)
def test_token_file_bytes(spark, tmp_path, unit, units, legacy, rows):
    kind = "array<float>" if unit is TokenUnit.F32 else "array<int>"
    df = spark.createDataFrame([(r,) for r in rows], f"tokens {kind}").coalesce(1)
    write_tokens(df, TokenFile(str(tmp_path), "x", unit=unit, units_per_token=units, legacy=legacy))
    body, index = golden(rows, unit, units, legacy)
    assert (tmp_path / "x_device_0.bin").read_bytes() == body and (tmp_path / "x_device_0.idx").read_bytes() == index
    assert not list(tmp_path.glob(".*"))
    back = read_tokens(spark, str(tmp_path / "x_device_0"), unit, units).orderBy("line").collect()
    assert [r["tokens"] for r in back] == rows


def test_token_file_order_devices_and_ranges(spark, tmp_path):
    rows = [(i, [i % 65536, i // 65536]) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, tokens array<int>").repartitionByRange(5, "i").sortWithinPartitions("i")
    assert write_tokens(df, TokenFile(str(tmp_path), "o", context_length=100)) == 53
    back = read_tokens(spark, str(tmp_path / "o_device_0")).where("line >= 1000 and line < 1003").orderBy("line")
    assert [(r["line"], r["tokens"][0]) for r in back.collect()] == [(1000, 1000), (1001, 1001), (1002, 1002)]
    assert line_count(str(tmp_path / "o_device_0")) == 3000
    lengths = read_tokens(spark, str(tmp_path / "o_device_0"), index_only=True)
    assert lengths.columns == ["file", "line", "num_tokens"] and lengths.agg(F.sum("num_tokens")).collect()[0][0] == 6000
    spec = TokenFile(str(tmp_path), "p", devices=None)
    write_tokens(df, spec)
    assert len(list(tmp_path.glob("p_device_*.bin"))) == 5 and not list(tmp_path.glob(".*"))
    back = source(spark, spec).collect()
    assert sorted(r["tokens"][0] for r in back) == list(range(3000)) and line_count(spec.files) == 3000
    write_tokens(df, TokenFile(str(tmp_path), "d", devices=7))
    every = read_tokens(spark, ",".join(str(tmp_path / f"d_device_{k}") for k in range(7)))
    assert sorted(r["tokens"][0] for r in every.collect()) == list(range(3000))


def test_token_file_refuses(spark, tmp_path):
    for rows, spec in [([[1, 2, 3]], {"units_per_token": 2}), ([[70000]], {}), ([[-1]], {})]:
        with pytest.raises(Exception, match="unit"):
            write_tokens(spark.createDataFrame([(r,) for r in rows], "tokens array<int>").coalesce(1), TokenFile(str(tmp_path), "bad", **spec))
    assert not list(tmp_path.glob(".*"))
    for bad in ({"devices": 0}, {"units_per_token": 0}, {"legacy": True, "unit": TokenUnit.U8}, {"context_length": 0}):
        with pytest.raises(ConfigError):
            TokenFile("p", "f", **bad)
    put(tmp_path / "m.idx", b"WRONG" + bytes(40))
    with pytest.raises(Exception, match="index"):
        read_tokens(spark, str(tmp_path / "m")).collect()


def test_truncated_token_file(spark, tmp_path):
    body, index = golden([[1, 2], [3], [4, 5]], TokenUnit.U16, 1, False)
    put(tmp_path / "t.bin", body[:-2])
    put(tmp_path / "t.idx", index)
    assert [r["tokens"] for r in read_tokens(spark, str(tmp_path / "t")).orderBy("line").collect()] == [[1, 2], [3]]


def test_keyed_store(spark, tmp_path):
    store = keyed.KeyedStore(spark, str(tmp_path))
    assert store.read(3).count() == 0
    store.write(spark.createDataFrame([("a_1", "x", 1), ("a_1", "y", 2), ("a%1", "z", 1)], "key string, value string, seq long"), 3, "seq")
    store.write(spark.createDataFrame([("a%1", "w")], "key string, value string"), 3)
    assert sorted(map(tuple, store.read(3).collect())) == [("a%1", "w"), ("a_1", "y")]
    assert [r["key"] for r in keyed.scan(store.read(3), "a_").collect()] == ["a_1"]
    with pytest.raises(ComponentError):
        store.read(4, missing="error")
    with pytest.raises(Exception, match="stop"):  # a write that fails changes nothing
        store.write(spark.createDataFrame([("a_1", "no")], "key string, value string").select("key", F.when(F.col("key") != "", F.raise_error(F.lit("stop"))).otherwise("").alias("value")), 3)
    assert sorted(map(tuple, store.read(3).collect())) == [("a%1", "w"), ("a_1", "y")]
    for k in range(20):
        store.write(spark.createDataFrame([(f"k{k % 7}", str(k))], "key string, value string"), 3)
    live, old = store._segments(3)
    assert len(live) <= store.SEGMENTS
    assert sorted(map(tuple, store.read(3).collect())) == [("a%1", "w"), ("a_1", "y")] + [(f"k{k}", str(k + 14 if k < 6 else 13)) for k in range(7)]
    rows = spark.createDataFrame([("a_1", 5)], "_key string, _copy int")
    hits, misses = keyed.lookup(rows, F.col("_key"), store.read(3))
    assert [tuple(r) for r in hits.collect()] == [("a_1", 5, "y")] and misses.columns == ["_key", "_copy"] and misses.count() == 0


def test_dense_ids_and_totals(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 as k", "id % 13 as v").repartition(7)
    got = sorted((r["k"], r["id"]) for r in ids.dense_ids(df, ["k"], 50).collect())
    assert got == [(k, 50 + k) for k in range(1000)]
    rows = sorted(ids.running_total(df, "v", ["k"], "before").collect(), key=lambda r: r["k"])
    total = 0
    for r in rows:
        assert r["before"] == total
        total += r["v"]
    assert ids.dense_ids(df.limit(0), ["k"]).count() == 0
    clash = spark.range(100).selectExpr("id as k", "id as _part", "'x' as _row", "id as _before").repartition(3)
    got = ids.dense_ids(clash, ["k"]).collect()
    assert {(r["k"], r["_part"], r["_row"], r["_before"], r["id"]) for r in got} == {(k, k, "x", k, k) for k in range(100)}
    arrived = ids.arrival_ids(spark.range(0, 1000, 1, 6).withColumnRenamed("id", "k"), 7).collect()
    assert all(r["id"] == r["k"] + 7 for r in arrived) and len(arrived) == 1000


def test_runner(spark, tmp_path):
    p = put(tmp_path / "a.jsonl", '{"text":"ab"}\nbad\n{"text":"é"}\n')
    spec = TokenFile(str(tmp_path), "b", unit=TokenUnit.U8)
    m = plans.jsonl_to_bytes(spark, Lines(p), [spec, Debug("x: ")])
    assert (m.read, m.sent, m.rejected) == (3, 2, 1)
    refused = Lines(str(tmp_path / "refused"))
    assert plans.jsonl_to_bytes(spark, Lines(p), [Debug()], rejects=refused).rejected == 1
    assert [r["content"] for r in source(spark, refused).collect()] == ["bad"]
    pair = lambda d: (d.where("content <> 'bad'"), d.where("content = 'bad'"))
    refused = Lines(str(tmp_path / "refused2"))
    assert run(spark, [Lines(p)], pair, [Debug()], rejects=refused).rejected == 1
    assert [r["content"] for r in source(spark, refused).collect()] == ["bad"]
    assert sorted(r["tokens"] for r in source(spark, spec).collect()) == [[97, 98, 3], [195, 169, 3]]
    assert run(spark, [], lambda d: (d, None), [Debug()]).read == 0
    assert run(spark, [Lines(p), Lines(p)], lambda d: (d, None), []).read == 6
    assert [x.read for x in chain([lambda: run(spark, [Lines(p)], lambda d: (d, None), [])] * 2, together=True)] == [3, 3]
    with pytest.raises(UnsupportedEndpointError):
        source(spark, Debug())


def test_text_plans(spark, tmp_path):
    from tokenforge.functions import bpe

    p = put(tmp_path / "a.jsonl", '{"text":"the then"}\n{"text":""}\n')
    spec = TokenFile(str(tmp_path), "t", context_length=1)
    v = bpe.byte_vocabulary(["the", " the"])
    m = plans.jsonl_to_tokens(spark, Lines(p), v, [spec])
    assert sorted(r["tokens"] for r in source(spark, spec).collect()) == [[0], [257, 258, ord("n") + 1, 0]] and m.primes == [2]
    assert plans.tokens_to_debug(spark, spec, Debug()).sent == 2
    counts = {r["byte"]: r["count"] for r in plans.jsonl_to_histogram(spark, Lines(p), str(tmp_path / "h")).collect()}
    assert len(counts) == 256 and counts[3] == 2 and counts[ord("e")] == 2 and sum(counts.values()) == 10
    lines = spark.read.text(str(tmp_path / "h")).collect()
    assert [r["value"].split(",")[0] for r in lines] == [str(i) for i in range(256)]


def test_protein_plans(spark, tmp_path):
    fasta = put(tmp_path / "e.1.fa", ">p1\nAC\n>p2 d\nK\n> none\nX\n")
    store = keyed.KeyedStore(spark, str(tmp_path / "kv"))
    kv = lambda db, prefix="": KeyValue(store.path, db, prefix)
    assert protein.eukaryota(spark, [Fasta(fasta), Fasta(str(tmp_path / "none.*"))], [kv(0)]).rejected == 1
    assert sorted(map(tuple, store.read(0).collect())) == [("protein:p1", "AC"), ("protein:p2", "K")]
    tsv = put(tmp_path / "s.tsv", "p1\tx\n\n p2 \np1\np9\n")
    rows, misses = protein.singletons_by_lookup(spark, Lines(tsv), store, 0, 1)
    assert rows.count() == 3 and [r["id"] for r in misses.collect()] == ["p9"]
    assert sorted(r["key"] for r in store.read(1).collect()) == [f"softlabel:{k}" for k in range(3)]
    protein.singletons_by_lookup(spark, Lines(tsv), store, 0, 1)  # numbers go on
    assert sorted(r["key"] for r in store.read(1).collect()) == [f"softlabel:{k}" for k in range(6)]
    labels = put(tmp_path / "l.jsonl", '[["a"],[{"A":1}]]\n[]\n[["b"],[{"C":0.5},{"D":0.5}]]\nbad\n')
    m = protein.labels_to_store(spark, Lines(labels), kv(2), pairs=True)
    assert (m.read, m.sent, m.rejected) == (4, 2, 2)
    protein.mix_stores(spark, store, {1: 1, 2: 4}, "softlabel:", 3)
    assert store.read(3).count() == 6 + 2 * 4
    spec = TokenFile(str(tmp_path), "v", unit=TokenUnit.F32, units_per_token=39)
    assert protein.store_to_vectors(spark, kv(3), [spec]).sent == 14
    got = sorted(r["num_tokens"] for r in source(spark, spec).collect())
    assert got == sorted([3, 2, 3] * 2 + [2, 3] * 4)
    one = put(tmp_path / "g.jsonl", '[{"A":1}]\n{"x":1}\n')
    assert protein.labels_to_store(spark, Lines(one), kv(4), pairs=False).sent == 2
    assert protein.genome_singletons(spark, Fasta(fasta), [kv(5)]).sent == 2
    assert {r["key"] for r in store.read(5).collect()} == {"softlabel:p1", "softlabel:p2"}


def test_jdbc(spark):
    spec = Jdbc("jdbc:derby:memory:unit;create=true", "T", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    df = spark.createDataFrame([(1, "a"), (2, None)], "ID int, NAME string")
    sink(df, spec)
    assert sorted(map(tuple, source(spark, spec).collect())) == [(1, "a"), (2, None)]
    with pytest.raises(ConfigError):
        source(spark, Jdbc(spec.url, "T", spec.driver, "ID"))


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "a.jsonl", '{"text":"ab"}\nbad\n')
    put(folder / "b.jsonl", '{"text":"c"}\n')
    spec = TokenFile(str(tmp_path / "out"), "s", unit=TokenUnit.U8)

    def transform(lines):
        good, bad = plans.texts(lines)
        return good.select(F.encode("text", "UTF-8").alias("tokens")), bad

    stream_to(stream_lines(spark, str(folder), 1), transform, [spec], str(tmp_path / "ck")).awaitTermination()
    files = ",".join(str(p)[:-4] for p in sorted((tmp_path / "out").glob("*.idx")))
    assert sorted(r["tokens"] for r in read_tokens(spark, files, TokenUnit.U8).collect()) == [[97, 98], [99]]
    for kind, spec in [("l", Lines(str(tmp_path / "l"))), ("f", Fasta(str(tmp_path / "f"))), ("x", Xml(str(tmp_path / "x"))), ("k", KeyValue(str(tmp_path / "k2")))]:
        put(folder / "c.jsonl", '{"text":"dd"}\n')
        shape = lambda d: plans.texts(d)[0].select(F.col("text").alias("key"), F.col("text").alias("value"), F.col("text").alias("id"), F.lit(None).cast("string").alias("desc"), F.col("text").alias("seq"))
        narrow = {"l": ["value"], "f": ["id", "desc", "seq"], "x": ["value"], "k": ["key", "value"]}[kind]
        stream_to(stream_lines(spark, str(folder), 1), lambda d: (shape(d).select(*narrow), None), [spec], str(tmp_path / f"ck-{kind}")).awaitTermination()  # noqa: B023
        back = source(spark, spec)
        assert sorted(r[0] for r in back.collect()) == ["ab", "c", "dd"] and "batch" not in back.columns
    store = keyed.KeyedStore(spark, str(tmp_path / "kv"))
    rows = stream_lines(spark, str(folder)).select(F.lit("k").alias("key"), F.col("content").alias("value"), F.length("content").cast("long").alias("seq"))
    stream_upserts(rows, store, 0, str(tmp_path / "ck2")).awaitTermination()
    assert [tuple(r) for r in store.read(0).collect()] in ([("k", '{"text":"ab"}')], [("k", '{"text":"dd"}')])


@pytest.mark.parametrize("pages", [7, 10_000])
def test_embedded_database_by_way_of_the_driver(spark, monkeypatch, pages):
    """On a cluster: no task reaches the database, so all rows go through the driver."""
    from tokenforge.sinks import jdbc as sinks
    from tokenforge.sources import jdbc as sources

    monkeypatch.setattr(sources, "at_hand", lambda *_: False)
    monkeypatch.setattr(sinks, "at_hand", lambda *_: False)
    spec = Jdbc(f"jdbc:derby:memory:far{pages};create=true", "T", "org.apache.derby.iapi.jdbc.AutoloadedDriver", fetch=pages, batch=pages)
    rows = spark.range(20).selectExpr("id AS A", "IF(id % 3 = 0, NULL, CONCAT('x', id)) AS B", "CAST(id / 4 AS DECIMAL(6, 2)) AS C", "id % 2 = 0 AS D", "TIMESTAMP '2024-01-02 03:04:05' AS E", "id / 3 AS F")
    sink(rows, spec)
    sink(rows.where("A < 2"), spec)
    back = source(spark, spec)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, [*rows.collect(), *rows.where("A < 2").collect()]), key=str)
    sink(rows.where("A < 0").select("A"), Jdbc(spec.url, "VACANT", spec.driver))
    assert source(spark, Jdbc(spec.url, "VACANT", spec.driver)).count() == 0
    assert spec.embedded and not Jdbc("jdbc:derby://host:1527/x", "T").embedded and not Jdbc("jdbc:postgresql://host/x", "T").embedded


def test_tasks_and_batches_of_token_files_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    """Few long lines are as many tasks as many short ones; each line is in one of them."""
    from tokenforge.sources import tokenfile

    spec = TokenFile(str(tmp_path), "b", unit=TokenUnit.U8)
    sizes = [0, 3000, 10, 10, 0, 900, 5000, 1, 1, 700, 700, 700]
    write_tokens(spark.createDataFrame([(bytearray([k] * n),) for k, n in enumerate(sizes)], "tokens binary").coalesce(1), spec)
    monkeypatch.setattr(tokenfile, "BYTES_A_TASK", 1000)
    monkeypatch.setattr(tokenfile, "BYTES_A_BATCH", 500)
    reader = tokenfile._Reader({"path": f"{tmp_path}/b_device_0", "unit": "u8"})
    parts = reader.partitions()
    assert len(parts) >= 6 and [x for p in parts for x in range(p.start, p.stop)] == list(range(len(sizes)))
    assert all(p.stop - p.start == 1 or sum(sizes[p.start : p.stop]) <= 1000 for p in parts)
    batches = [b for p in parts for b in reader.read(p)]
    assert all(b.num_rows == 1 or len(b.column(3).flatten()) <= 500 for b in batches)
    assert [(x["line"], x["tokens"]) for b in batches for x in b.to_pylist()] == [(k, [k] * n) for k, n in enumerate(sizes)]
    assert [(p.start, p.stop) for p in tokenfile._Reader({"path": f"{tmp_path}/b_device_0", "columns": "index"}).partitions()] == [(0, len(sizes))]
