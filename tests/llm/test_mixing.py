import math
import random
import re
import string
import warnings
from collections import Counter

import numpy as np
import pytest
import regex

from tests.llm.cases import documents, frame, words
from tokenforge.llm import mixing as M


def made(n=300):
    r = random.Random(8)
    rows, labels = [], []
    marks = {"a": "alpha beta gamma".split(), "b": "delta epsilon zeta".split()}
    for i in range(n):
        d = "a" if r.random() < 0.8 else "b"
        w = words(r, r.randint(20, 80)) + r.sample(marks[d], 2) * 2
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, d))
    return rows, labels


def labels_frame(spark, labels):
    return spark.createDataFrame([(i, d, "x") for i, d in labels], "doc_id long, domain string, word string")


def totals(rows, names):
    return {k: sum(r["n_tokens"] * r[f"p_{k}"] * r["rate"] for r in rows) for k in names}


def test_targets_are_met(spark):
    rows, labels = made()
    out = M.mixed(frame(spark, rows), labels_frame(spark, labels), {"a": 0.3, "b": 0.7}).collect()
    assert len(out) == len(rows) and all(r["rate"] >= 0 for r in out)
    tokens = sum(len(t.split()) for _, t in rows)
    assert sum(r["n_tokens"] for r in out) == tokens
    got = totals(out, "ab")
    assert got["a"] == pytest.approx(0.3 * tokens, rel=0.02) and got["b"] == pytest.approx(0.7 * tokens, rel=0.02)
    truth = dict(labels)
    assert sum((r["p_a"] > 0.5) == (truth[r["doc_id"]] == "a") for r in out) >= 0.95 * len(out)


def plain_rates(n, p, targets, rounds=60_000):
    """Projected gradient on the rates themselves, with a fixed step below the inverse of the steepest curvature."""
    total = n.sum()
    want, pull = np.array(targets) * total, M.PULL * total
    a = (n[:, None] * p).T  # totals = a @ rates
    curve = np.linalg.eigvalsh((a / n) @ a.T)[-1] + pull  # in the metric of n
    r = np.ones(len(n))
    z, t = r.copy(), 1.0
    for _ in range(rounds):
        new = np.maximum(0, z - (p @ (a @ z - want) + pull * (z - 1)) / curve)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, r, t = (new + (t - 1) / s * (new - r), new, s) if (new - r) @ (z - new) <= 0 else (new, new, 1.0)
    return r


@pytest.mark.parametrize("targets", [[0.2, 0.5, 0.3], [0.9, 0.05, 0.05], [0.98, 0.01, 0.01]])
def test_rates_like_plain_projected_gradient(spark, targets):
    r = np.random.default_rng(5)
    n = r.integers(1, 50, 80).astype(float)
    p = r.dirichlet([0.3, 0.3, 0.3], 80)
    df = spark.createDataFrame([(i, int(x), *map(float, y)) for i, (x, y) in enumerate(zip(n, p, strict=True))], "i int, n_tokens long, p_0 double, p_1 double, p_2 double")
    steps = M.fit_rates(df, targets)
    got = np.array([x["rate"] for x in df.withColumn("rate", M.fitted_rate([M.F.col(f"p_{k}") for k in range(3)], steps)).orderBy("i").collect()])
    assert np.allclose(got, plain_rates(n, p, targets), atol=2e-3)
    if targets[0] < 0.95:  # the last can only just be met, so the pull towards 1 shows
        assert (n * got) @ p == pytest.approx(np.array(targets) * n.sum(), rel=1e-3)


def plain_features(text):
    text = text or ""
    w = [x for x in re.split("[ \n\t\r]", text) if x]
    share = lambda part, whole: min(9, part * 10 // whole) if whole else 0
    capitals = sum(c in string.ascii_uppercase for c in text)
    bins = {f"{M._REPEATS}{share(len(set(w)), len(w))}", f"{M._CAPITALS}{share(capitals, len(text))}"}
    return len(w), set(regex.findall(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+", text.lower())) | bins


def plain_bayes(rows, labels, domains):
    """Words' evidence, the evidence of none, and priors."""
    known = [(plain_features(dict(rows)[i])[1], d) for i, d in labels]
    bins = {f"{x}{k}" for x in (M._REPEATS, M._CAPITALS) for k in range(10)}
    total, own = len(known), Counter(d for _, d in known)
    evidence, missing = {}, [0.0] * len(domains)
    for w in bins.union(*(f for f, _ in known)):
        n = sum(w in f for f, _ in known)
        everywhere, ps, value = (n + 0.5) / (total + 1), [], 0.0
        for d in domains:
            k = sum(w in f for f, x in known if x == d)
            ps.append(min(0.999, (k + everywhere) / (own[d] + 1)))
            value = max(value, 2 * k * math.log(ps[-1] / everywhere) if ps[-1] >= M.LIFT * everywhere else 0.0)
        if w in bins or value >= M.SURE:
            evidence[w] = [math.log(p / (1 - p)) for p in ps]
            missing = [m + math.log(1 - p) for m, p in zip(missing, ps, strict=True)]
    return evidence, missing, [math.log(own[d] / total) for d in domains]


def test_posteriors_like_plain_naive_bayes(spark):
    rows, labels = made(150)
    rows += [(5000 + k, t) for k, (_, t) in enumerate(documents())]
    docs = frame(spark, rows).select("doc_id", "text")
    words, missing, priors, temper = M.vocabulary(docs, labels_frame(spark, labels), ["a", "b"])
    evidence, want_missing, want_priors = plain_bayes(rows, labels, ["a", "b"])
    assert {r["word"] for r in words.collect()} == set(evidence) and temper in M.TEMPERS
    assert missing == pytest.approx(want_missing) and priors == pytest.approx(want_priors)
    got = {r["doc_id"]: r for r in M.posteriors(docs, words, missing, priors, temper).collect()}
    for i, t in rows:
        n, found = plain_features(t)
        logit = np.array([want_priors[k] + temper * (want_missing[k] + sum(evidence[w][k] for w in found if w in evidence)) for k in range(2)])
        p = np.exp(logit - logit.max())
        assert got[i]["n_tokens"] == n and [got[i]["p_0"], got[i]["p_1"]] == pytest.approx(list(p / p.sum()), abs=1e-9)


def test_targets_that_no_rates_meet_are_told(spark):
    df = spark.createDataFrame([(10, 0.5, 0.5), (30, 0.5, 0.5)], "n_tokens long, p_0 double, p_1 double")
    with pytest.warns(UserWarning, match="off its target by 0.4 of the budget"):
        M.fit_rates(df, [0.1, 0.9])
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        M.fit_rates(df, [0.5, 0.5])


def test_gaps_of_the_registered_query(spark, sf):
    out = M.op2_mixing(spark, sf)
    got = {r["domain"]: r for r in M.gaps(out, M.TARGETS).collect()}
    tokens = sum(r["n_tokens"] for r in out.collect())
    assert sum(r["wanted"] for r in got.values()) == pytest.approx(tokens) and set(got) == set(M.TARGETS)
    for r in got.values():
        assert r["expected"] == pytest.approx(r["wanted"], rel=0.01)


def test_unseen_domain_and_odd_rows(spark):
    rows, labels = made(120)
    docs = frame(spark, rows + [(5000 + k, t) for k, (_, t) in enumerate(documents())] + [(None, "alpha beta"), (0, "alpha beta")])
    out = M.mixed(docs, labels_frame(spark, labels + [(None, "a"), (3, None), (4, "other")]), {"a": 0.5, "b": 0.25, "c": 0.25}).collect()
    assert len(out) == len(rows) + len(documents()) + 2
    assert all(r["p_c"] == 0 and r["rate"] >= 0 for r in out)
    got = totals(out, "ab")
    assert got["a"] == pytest.approx(2 * got["b"], rel=0.05)


def test_no_labels_no_documents(spark):
    rows, labels = made(30)
    assert {r["rate"] for r in M.mixed(frame(spark, rows), labels_frame(spark, []), {"a": 1.0}).collect()} == {1.0}
    assert M.mixed(frame(spark, []), labels_frame(spark, labels), {"a": 0.5, "b": 0.5}).count() == 0


def test_main_path_is_native(spark, sf):
    out = M.op2_mixing(spark, sf)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
