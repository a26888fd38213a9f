import hashlib
from collections import Counter

import pytest

from tests.llm.cases import documents, frame, tuples
from tokenforge.llm import substring_dedup as S


def brute(rows, width=200):
    seen = Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raws:
        seen.update(b[k : k + width] for k in range(len(b) - width + 1))
    out = []
    for i, b in raws:
        spans = S.merged([(k, k + width) for k in range(len(b) - width + 1) if seen[b[k : k + width]] > 1])
        out.append((i, len(b), sum(e - s for s, e in spans), len(spans), hashlib.sha256(S.kept_bytes(b, spans)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [4096, 2])
def test_like_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rows = documents()
    assert tuples(S.substring_dedup(frame(spark, rows))) == brute(rows)


def test_registered_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert tuples(S.op1_substring_dedup(spark, sf)) == brute(rows)


def test_empty_table(spark):
    assert tuples(S.substring_dedup(frame(spark, []))) == []


def test_windows_of_small_collection():
    texts = [b"x" * 70 + b"abcdefgh" * 30, b"y" * 70 + b"abcdefgh" * 30]
    import numpy as np

    found = {(c, int(i)) for c, who in S.repeated_windows(S.Columns(texts, np.array([70, 70])), 200) for i in who}
    want = {(c, i) for c in range(len(texts[0]) - 199) for i in (0, 1) if texts[0][c : c + 200] == texts[1][c : c + 200]}
    assert want <= found


def test_copies_move_their_text_once_a_batch():
    """Before, each copy that loses bytes was moved with its whole text."""
    import types
    import zlib

    import numpy as np
    import pyarrow as pa

    from tokenforge.llm.shared import Filter

    texts = ["copy " * 4000] * 500 + ["other " * 100, None]
    heads = S._heads([S.text_digest((t or "").encode()) for t in texts])
    losing = Filter(2)
    losing.add(heads[[0, 500]])
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    moved = pa.Table.from_batches(S._texts(types.SimpleNamespace(value=losing))(iter([batch])))
    assert [zlib.decompress(x).decode() for x in moved.column("text").to_pylist()] == [texts[0], texts[500]]
    assert moved.nbytes < 10_000 < len(texts[0])
    spans = [np.array([(0, 200), (300, 500)], np.int64).tobytes()] * 2
    cut = pa.Table.from_batches(S._cut(iter([pa.RecordBatch.from_arrays([*moved.combine_chunks().to_batches()[0].columns, pa.array(spans)], names=["t", "text", "spans"])])))
    left = [t.encode()[200:300] + t.encode()[500:] for t in (texts[0], texts[500])]
    assert cut.column("kept").to_pylist() == [hashlib.sha256(x).hexdigest() for x in left]
    assert cut.column("n_removed").to_pylist() == [400, 400] and cut.column("n_spans").to_pylist() == [2, 2]


def steps(node):
    """Most Python steps of one task in a plan's last stage, and of any stage below."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return steps(node.initialPlan())
    below = [steps(node.children().apply(i)) for i in range(node.children().size())]
    most = max((m for _, m in below), default=0)
    here = [h for h, _ in below] or [0]
    n = (max(here) if name == "Union" else sum(here)) + ("MapInArrow" in name)
    return (0 if "Exchange" in name else n), max(most, n)


def test_no_stage_has_two_python_steps(spark, monkeypatch):
    """Before, texts were packed and cut in one stage of small tables, and a filter's values came from a step of their own."""
    plans = {}

    def seen(f, extra):
        def run(df, name, *rest):
            plans[name] = steps(df._jdf.queryExecution().executedPlan())[1] + extra
            return f(df, name, *rest)

        return run

    monkeypatch.setattr(S, "stored", seen(S.stored, 0))
    monkeypatch.setattr(S, "made_filter", seen(S.made_filter, 1))
    out = S.substring_dedup(frame(spark, documents()))
    plans["out"] = steps(out._jdf.queryExecution().executedPlan())[1]
    assert {"contexts", "grams", "spans", "cut"} < set(plans) and plans["contexts"] == plans["cut"] == 1
    assert max(plans.values()) == 1, plans


def test_windows_are_sorted_in_pieces():
    """Before, all windows of a batch were held and sorted at once, 100 bytes and more for each."""
    import random
    import tracemalloc
    import types

    import numpy as np
    import pyarrow as pa

    from tokenforge.llm.shared import Filter

    some = random.Random(1)
    texts = ["".join(some.choices("abcdefgh ", k=3000)) for _ in range(700)]
    every = Filter(2)
    every.packed[:] = 255
    run = S._windows(types.SimpleNamespace(value=(None, every)), 200)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    tracemalloc.start()
    n = sum(int(np.sum(b.column("salt").to_numpy() == 0)) for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 700 * (3000 - 199)
    assert peak < 130e6, peak


def test_small_pieces_like_brute_force(spark, monkeypatch):
    for name, size in (("HOT", 2), ("TEXTS", 3), ("STRINGS", 2), ("WINDOWS", 50)):
        monkeypatch.setattr(S, name, size)
    rows = documents()
    assert tuples(S.substring_dedup(frame(spark, rows))) == brute(rows)
