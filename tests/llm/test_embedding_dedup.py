import math
import random

import numpy as np
import pytest

from tests.llm.cases import tuples
from tokenforge.llm import embedding_dedup as V


def vectors():
    r = np.random.default_rng(4)
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [1.0, None] + [0.0] * 6), (5, [math.nan] * 8), (6, [math.inf] + [0.0] * 7), (7, [1.0] * 4), (8, [2.0] * 4)]
    base = r.normal(size=(6, 8))
    for i in range(60):
        v = base[i % 6] + r.normal(size=8) * r.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((100 + i, [float(np.float32(x)) for x in v * r.choice([1e-3, 1, 1e3])]))
    rows += [(200 + i, [float(x) for x in np.float32(base[0])]) for i in range(40)]  # a group of copies
    rows += [(300, rows[-1][1]), (300, rows[-1][1])]
    return rows


def brute(rows, threshold=0.9):
    good = []
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.append((k, np.array(v, np.float64)))
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(good):
        for j, y in good[:a]:
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for k, (v, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), v), v)
    return sorted(((v, links[k], least[find(k)], least[find(k)] == v) for k, (v, _) in enumerate(rows)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, row int, raw string").repartition(3)


@pytest.mark.parametrize("tile", [2048, 10])
def test_like_brute_force(spark, tile):
    rows = vectors()
    assert tuples(V.embedding_dedup(frame(spark, rows), tile=tile)) == brute(rows)


def test_error_bound_holds():
    r = np.random.default_rng(1)
    x = V._unit(r.normal(size=(300, 64)) * r.choice([1, 50], size=(300, 64), p=[0.98, 0.02]))
    q, s, e = V.quantised(x)
    off = np.abs((q * s[:, None]) @ (q * s[:, None]).T - x @ x.T)
    bound = (1 + e)[:, None] * e[None] + e[:, None] * (1 + e)[None] + e[:, None] * e[None]
    assert (off <= bound + 1e-12).all()


def test_few_pairs_are_computed_in_full():
    r = np.random.default_rng(2)
    x = r.normal(size=(500, 64))
    x[250:] = x[:250] + r.normal(size=(250, 64)) * np.linspace(0, 1, 250)[:, None]
    codes = V.quantised(V._unit(x))
    rows, cols, rows2, cols2 = V.settled(codes, codes, 0.9, True)
    cos = V._unit(x) @ V._unit(x).T
    truth = {(i, j) for i, j in zip(*np.nonzero(cos >= 0.9), strict=True) if i < j}
    sure, open_ = set(zip(rows, cols, strict=True)), set(zip(rows2, cols2, strict=True))
    assert sure <= truth <= sure | open_ and len(sure) > 50 and 0 < len(open_) < 50


def test_tile_pairs_are_found_once(spark, monkeypatch):
    monkeypatch.setattr(V, "GROUP", 3)
    import struct

    rows = [(8, f"t{i}", struct.pack("<8d", 1.0, *[0.0] * 7), 1.0) for i in range(20)] + [(4, f"u{i}", struct.pack("<4d", 1.0, 0, 0, 0), 1.0) for i in range(2)]
    got = tuples(V._near_tiles(spark.createDataFrame(rows, "dim int, tile string, centre binary, radius double"), 0.5))
    assert len(got) == len({frozenset(p) for p in got}) == 20 * 21 // 2 + 3


def test_forest_spans_components():
    r = random.Random(3)
    edges = [(r.randrange(50), r.randrange(50)) for _ in range(60)]
    rows, cols = np.array(edges).T
    got = V.forest(50, rows, cols)

    def parts(pairs):
        p = list(range(50))
        for a, b in pairs:
            x, y = p[a], p[b]
            p = [y if z == x else z for z in p]
        return [p.index(z) for z in p]

    assert parts(got) == parts(edges) and len(got) == 50 - len(set(parts(edges)))


def test_registered_query(spark, sf):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert tuples(V.op8_embedding_dedup(spark, sf)) == brute(rows)


def test_empty_table(spark):
    assert tuples(V.embedding_dedup(frame(spark, []))) == []
