import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import documents
from tokenforge.llm import shared
from tokenforge.llm import textkit as tk
from tokenforge.llm.shared import Filter, components, made_filter, whole_groups


def test_whole_groups():
    r = random.Random(2)
    for _ in range(50):
        keys = sorted((r.randrange(6), r.randrange(2)) for _ in range(r.randint(0, 40)))
        cuts = sorted({0, len(keys), *(r.randint(0, len(keys)) for _ in range(6))})
        batches = [
            pa.RecordBatch.from_pydict({"a": [k[0] for k in keys[i:j]], "b": [k[1] for k in keys[i:j]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
            for i, j in zip(cuts, cuts[1:], strict=False)
        ]
        got = [list(zip(t.column("a").to_pylist(), t.column("b").to_pylist(), strict=True)) for t in whole_groups(iter(batches), ["a", "b"])]
        assert sum(got, []) == keys
        for x, y in zip(got, got[1:], strict=False):
            assert x[-1] != y[0]


def test_filter_misses_nothing(spark):
    x = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000)
    f = Filter(len(x))
    f.add(x)
    assert f.has(x).all()
    assert f.has(x + 1).mean() < 0.05
    g = made_filter(spark.createDataFrame([(int(i),) for i in x[:500]], "v long").repartition(3), "v", 500)
    assert g.has(x[:500]).all() and g.has(x[500:]).mean() < 0.05


def test_word_hashes_tell_words_apart():
    texts = [t for _, t in documents()]
    buf, off = tk.flat(pa.array(texts))
    seen: dict[int, bytes] = {}
    for a, b in tk.slices(off, 1000):
        low, own = tk.LOWER[buf[off[a] : off[b]]], off[a : b + 1] - off[a]
        starts, ends, rows = tk.word_spans(low, own, tk.GRAPH)
        raw = low.tobytes()
        for h, s, e, r in zip(tk.Hasher().spans(low, starts, ends).tolist(), starts, ends, rows, strict=True):
            assert seen.setdefault(h, raw[s:e]) == raw[s:e]
            assert own[r] <= s < e <= own[r + 1]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_of_few_edges_need_no_rounds(spark, monkeypatch, kind):
    r = random.Random(5)
    path = list(range(-20, 60))
    r.shuffle(path)
    pairs = [*zip(path, path[1:], strict=False), *((100, k) for k in range(101, 140)), (200, 200), (None, 100), (300, 301), (301, 300)]
    name = (lambda x: x) if kind == "long" else (lambda x: None if x is None else f"é{x}")
    groups = [path, range(100, 140), [300, 301]]
    want = sorted((name(x), min(map(name, g))) for g in groups for x in g)
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], f"src {kind}, dst {kind}")
    written = []
    monkeypatch.setattr(shared, "stored", lambda df, name, f=shared.stored: written.append(name) or f(df, name))
    assert sorted(map(tuple, components(edges).collect())) == want
    assert len(written) == 1  # before, each round wrote three tables
    # some rounds first, then one task
    monkeypatch.setattr(shared, "FEW_EDGES", 20)
    assert sorted(map(tuple, components(edges).collect())) == want
    # rounds alone
    monkeypatch.setattr(shared, "FEW_EDGES", 0)
    assert sorted(map(tuple, components(edges).collect())) == want


def test_lean_gives_back_what_was_freed():
    import subprocess
    import sys

    code = """
import ctypes, re
import numpy as np
from tokenforge.llm.shared import lean
pins = []
def run(batches):
    held = [np.ones(1 << 12) for _ in range(4000)]
    pins.append(np.ones(1 << 12))  # the heap's end stays in use
    yield from batches
def mb():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
def kept(f):
    before = mb()
    list(f(iter([])))
    return mb() - before
print(hasattr(ctypes.CDLL(None), "malloc_trim"), kept(lean(run)), kept(run))
"""
    glibc, after, plain = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120).stdout.split()
    assert glibc == "False" or float(after) < 30 < 100 < float(plain)
