import glob
import gzip
import hashlib

from tests.llm.cases import tuples
from tokenforge.llm import warc as W

BIG = "<p>" + "é" * 200
PAGES = [(5, "http://a/", BIG), (3, "http://b/", BIG), (9, None, BIG), (1, "http://c/", "short"), (2, "http://d/\r\nX: y", "short"), (4, "u", None), (6, "v", ""), (7, "w", "\r\n\r\nbody" * 50), (8, "w", "\r\n\r\nbody" * 50)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, file string").repartition(3)


def brute(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        r = first.get(b, i)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if r == i else "revisit", None if r == i else r))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    index = W.write_archive(pages(spark, PAGES), f"file://{tmp_path}/warc")
    back = W.read_archive(index, f"file://{tmp_path}/warc", keep_payload=True)
    assert tuples(back.drop("payload")) == brute(PAGES)
    payload = {r["page_id"]: r["payload"] for r in back.collect()}
    assert bytes(payload[3]).decode() == BIG and payload[5] is None and bytes(payload[4]) == b""


def test_selection_and_files(spark, tmp_path):
    index = W.write_archive(pages(spark, PAGES), f"file://{tmp_path}/warc")
    assert tuples(W.read_archive(index.where("page_id in (1, 9)"), f"file://{tmp_path}/warc")) == [x for x in brute(PAGES) if x[0] in (1, 9)]
    rows = index.collect()
    for path in glob.glob(f"{tmp_path}/warc/*.warc.gz"):  # each record is a gzip member at its offset
        with open(path, "rb") as f:
            data = f.read()
        mine = sorted((r["offset"], r["length"]) for r in rows if path.endswith(r["file"]))
        assert mine[0][0] == 0 and sum(n for _, n in mine) == len(data)
        for offset, length in mine:
            assert gzip.decompress(data[offset : offset + length]).startswith(b"WARC/1.1\r\n")


def test_registered_query(spark, sf):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert tuples(W.op7_warc(spark, sf)) == brute(rows)


def test_one_response_a_payload_where_ids_repeat(spark, tmp_path):
    rows = [(3, "a", BIG), (3, "b", BIG), (5, "c", BIG), (3, "d", "other" * 50), (None, "e", "null" * 50), (None, "f", "null" * 50)]
    back = W.read_archive(W.write_archive(pages(spark, rows), f"file://{tmp_path}/a"), f"file://{tmp_path}/a", keep_payload=True).collect()
    for text in (BIG, "other" * 50, "null" * 50):
        own = [r for r in back if r["payload_digest"] == hashlib.sha256(text.encode()).hexdigest()]
        first = [r for r in own if r["record_type"] == "response"]
        least = min((i for i, _, h in rows if h == text and i is not None), default=None)
        assert len(first) == 1 and first[0]["page_id"] == least and bytes(first[0]["payload"]).decode() == text
        assert {r["refers_to"] for r in own if r["record_type"] == "revisit"} <= {least}


def test_null_id_and_empty_table(spark, tmp_path):
    got = tuples(W.read_archive(W.write_archive(pages(spark, [(None, "a", BIG), (2, "b", BIG)]), f"file://{tmp_path}/a"), f"file://{tmp_path}/a"))
    assert [(r[0], r[3], r[4]) for r in got] == [(2, "response", None), (None, "revisit", 2)]
    assert tuples(W.read_archive(W.write_archive(pages(spark, []), f"file://{tmp_path}/b"), f"file://{tmp_path}/b")) == []
