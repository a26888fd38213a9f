import hashlib
import re

from pyspark.sql import Row

from tests.llm.cases import documents, frame, tuples
from tokenforge.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, items, window=10):
    windows = {}
    for i, t in items:
        w = WORD.findall(low(t))
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for i, t in rows:
        w, found = WORD.findall(low(t)), set()
        hit = [False] * len(w)
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                x = windows.get(tuple(w[k : k + size]))
                if x:
                    found |= x
                    hit[k : k + size] = [True] * size
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), sum(hit) > 0))
    return sorted(out, key=repr)


def items_of(rows):
    text = dict((i, t) for i, t in rows if i is not None)
    long = text[60].split()
    return [
        (1, " ".join(long[100:125])),
        (2, " ".join(long[110:118])),  # shorter than a window
        (3, "one TWO three"),
        (4, None),
        (5, "..."),
        (6, " ".join(long[105:130])),
        (None, text[40][:200]),
        (7, "ka"),
        (7, "to mi"),
    ]


def items_frame(spark, items):
    return spark.createDataFrame([Row(item_id=i, text=t, n="x") for i, t in items], "item_id long, text string, n string")


def test_like_brute_force(spark):
    rows = documents()
    items = items_of(rows)
    assert tuples(D.contamination(frame(spark, rows), items_frame(spark, items))) == brute(rows, items)


def test_several_automata(spark, monkeypatch):
    monkeypatch.setattr(D, "SLICE_WORDS", 20)
    rows = documents()
    items = items_of(rows)
    assert len(D.automata(items_frame(spark, items))) >= 3
    monkeypatch.setattr(D, "BLOCK", 2000)  # and several blocks of texts
    assert tuples(D.contamination(frame(spark, rows), items_frame(spark, items))) == brute(rows, items)


def test_registered_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert tuples(D.op3_decontamination(spark, sf)) == brute(rows, items)


def test_removal(spark):
    passage = "p0 p1 p2 p3 p4 p5 p6 p7 p8 p9 p10"
    clean = " ".join(f"c{i}" for i in range(40))
    rows = [(1, f"{clean}; {passage}! {clean}"), (2, passage), (3, clean), (4, None)]
    got = {r["doc_id"]: r for r in D.decontaminated(frame(spark, rows), items_frame(spark, [(1, passage)])).collect()}
    assert sorted(got) == [1, 3, 4]
    assert got[1]["text"] == f"{clean}; ! {clean}" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["text"] == clean and got[4]["text"] is None


def test_empty_tables(spark):
    rows = documents()
    assert tuples(D.contamination(frame(spark, []), items_frame(spark, [(1, "a b")]))) == []
    assert tuples(D.contamination(frame(spark, rows), items_frame(spark, []))) == brute(rows, [])
