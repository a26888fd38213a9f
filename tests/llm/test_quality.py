import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.cases import documents, frame, words
from tokenforge.llm import quality as Q
from tokenforge.llm import textkit as tk


def made(n=400):
    import random

    r = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = r.random() < 0.7
        w = words(r, r.randint(30, 120))
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "!!" for x in w)))
        labels.append((i, int(good)))
    return rows, labels


def labels_frame(spark, labels):
    return spark.createDataFrame([(i, q, "x") for i, q in labels], "doc_id long, quality int, score string")


def test_held_out_accuracy(spark):
    rows, labels = made()
    docs = frame(spark, rows)
    model = Q.fit(docs, labels_frame(spark, labels))
    got = {r["doc_id"]: r["p"] for r in model.scored(docs, "p").collect()}
    held = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and sum((got[i] >= 0.5) == (q == 1) for i, q in held) >= 0.97 * len(held)


def test_word_vectors_cover_all_documents(spark):
    rows, labels = made(60)
    rest = [(900 + k, "zork blip " * 5 + t) for k, (_, t) in enumerate(rows)] + documents() + [(990, "zork " * 20_000), (991, "one")]
    got = Q.fit(frame(spark, rows + rest), labels_frame(spark, labels)).words
    pairs = Counter()
    for _, t in rows + rest:
        w = [int(x) for p in Q._pieces(pa.array([t or ""])) for x in Q._bucket(p[7])]
        for step in range(1, Q.NEAR + 1):
            for x, y in zip(w, w[step:]):  # noqa: B905
                pairs[x, y] += 1
                pairs[y, x] += 1
    index, want = Q._index_vectors(np.arange(Q.BUCKETS)), np.zeros((Q.BUCKETS, Q.DIM))
    for (x, y), n in pairs.items():
        want[x] += n * index[y]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1)
    want += index / np.sqrt(8)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, want, atol=1e-5)


def test_pooling_like_plain_loops():
    r = np.random.default_rng(1)
    table = r.normal(size=(Q.BUCKETS, Q.DIM)).astype(np.float32)
    texts = [t for _, t in documents()] + ["A-b", "x&&& y***\n\u00e9\u00fc!", "  "]
    got = Q.pooled(pa.array(texts, pa.string()), table)
    for t, x in zip(texts, got, strict=True):
        # runs of letters and digits (and all beyond ASCII), and of other signs
        runs = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", (t or "").encode())
        if not runs:
            assert not x.any()
            continue
        places = {w: int(Q._bucket(tk.Hasher().spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)])))[0]) for w in set(runs)}
        v = table[[places[w] for w in runs]].astype(np.float64)
        assert np.allclose(x, np.concatenate((v.mean(0), v.std(0))), atol=1e-4)


def test_gradients_like_differences_and_temperature_like_search():
    r = np.random.default_rng(2)
    z, y = r.normal(size=(7, 5)), np.array([0, 1, 1, 0, 1, 0, 1.0])
    p = [r.normal(size=(5, 4)), r.normal(size=4), r.normal(size=4), r.normal(size=1)]

    def loss():
        logit = np.maximum(z @ p[0] + p[1], 0) @ p[2] + p[3][0]
        chance = 1 / (1 + np.exp(-logit))
        return -np.mean(y * np.log(chance) + (1 - y) * np.log(1 - chance)) + Q.PENALTY / 2 * ((p[0] ** 2).sum() + (p[2] ** 2).sum())

    for part, g in zip(p, Q.gradients(p, z, y), strict=True):
        for at in np.ndindex(part.shape):
            part[at] += 1e-6
            up = loss()
            part[at] -= 2e-6
            assert abs((up - loss()) / 2e-6 - g[at]) < 1e-6
            part[at] += 1e-6
    # logits three times too large want a temperature near 3
    logit = r.normal(size=20_000) * 2
    y = (r.random(20_000) < 1 / (1 + np.exp(-logit))).astype(float)
    assert 2.6 < Q.best_temperature(3 * logit, y) < 3.5
    x = r.normal(size=(400, 6))
    net = Q.Network(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float))
    assert ((net.score(x) >= 0.5) == (x[:, 0] + x[:, 1] * x[:, 2] > 0)).mean() > 0.95


def test_held_out_labels_do_not_matter(spark):
    rows, labels = made(150)
    docs = frame(spark, rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    a, b = ({r["doc_id"]: r["p"] for r in Q.fit(docs, labels_frame(spark, x)).scored(docs, "p").collect()} for x in (labels, turned))
    assert a == b


def test_registered_query_on_all_rows(spark, sf):
    got = Q.op5_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_edge_cases(spark):
    rows, labels = made(60)
    odd = documents()
    docs = frame(spark, [(1000 + i, t) for i, (_, t) in enumerate(odd)] + rows)
    model = Q.fit(docs, labels_frame(spark, labels + [(None, 1), (1, None), (2, 7), (5, 1), (5, 0)]))
    got = [r["p"] for r in model.scored(frame(spark, odd), "p").collect()]
    assert len(got) == len(odd) and all(0 <= p <= 1 for p in got)
    assert model.scored(frame(spark, []), "p").count() == 0


def test_no_labels_and_one_class(spark):
    docs = frame(spark, documents())
    assert {r["p"] for r in Q.fit(docs, labels_frame(spark, [])).scored(docs, "p").collect()} == {0.5}
    assert {r["p"] for r in Q.fit(docs, labels_frame(spark, [(10, 1), (11, 1), (12, 1), (20, 1)])).scored(docs, "p").collect()} == {1.0}
