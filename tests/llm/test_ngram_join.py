import re
from collections import Counter, defaultdict

import pytest

from tests.llm.cases import documents, frame, tuples
from tokenforge.llm.ngram_join import distinct_documents, ngram_join, op4_ngram_join

WORD = re.compile("[^\x20\x09-\x0d]+")


def sets_of(rows, n):
    out = []
    for i, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append((i, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    return out


def brute(rows, n=4, percent=85):
    sets = sets_of(rows, n)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, ids = defaultdict(list), {}
    for k, (i, s) in enumerate(sets):
        common = Counter(q for g in s for q in where[g])
        for q, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[q][1]) - both):
                parent[max(find(k), find(q))] = min(find(k), find(q))
        for g in s:
            where[g].append(k)
    for k, (i, _) in enumerate(sets):
        ids.setdefault(find(k), []).append(i)
    named = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return sorted(((i, len(s), named[find(k)]) for k, (i, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("tile", [512, 3])
def test_like_brute_force(spark, tile):
    rows = documents()
    assert tuples(ngram_join(frame(spark, rows), tile=tile)) == brute(rows)


@pytest.mark.parametrize(("led", "salts"), [(4096, 32), (5, 3)])
def test_many_near_copies(spark, monkeypatch, led, salts):
    import random

    from tests.llm.cases import SYLLABLES, words

    monkeypatch.setattr("tokenforge.llm.ngram_join.LED", led)
    monkeypatch.setattr("tokenforge.llm.ngram_join.SALTS", salts)
    r = random.Random(1)
    base, rows = words(r, 120), []
    for i in range(300):
        w = list(base[: r.randint(90, 120)])
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(SYLLABLES)
        rows.append((i, " ".join(w)))
    want = brute(rows)
    assert tuples(ngram_join(frame(spark, rows), tile=40)) == want


def test_common_passages_make_no_work(spark, monkeypatch):
    import random

    from tests.llm.cases import words
    from tokenforge.llm import ngram_join as N

    made, units = [], N._units

    def counted(*args):
        out = units(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(N, "_units", counted)
    r = random.Random(5)
    passage = " ".join(words(r, 40))
    rows = [(i, " ".join(words(r, 40)) + " " + passage) for i in range(200)]
    rows += [(200 + i, t + " more") for i, t in rows[:5]]
    assert tuples(ngram_join(frame(spark, rows), tile=8)) == brute(rows)
    assert made[0] <= 2 * len(rows)


def test_texts_that_no_class_needs_are_not_cut_again(monkeypatch):
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from tokenforge.llm import ngram_join as N
    from tokenforge.llm.shared import Filter

    rows = [(i, f"the words of text {i % 20} are these and no more") for i in range(40)] + [(None, "a text of its own without a name")]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    digests = [N.set_digest(s) for s in N.ngram_sets(batch.column("text"), 4)]
    wanted, cut, sets = Filter(100), [], N.ngram_sets
    wanted.add(np.array([digests[3], 3, digests[7], 7, digests[40]], np.int64))
    monkeypatch.setattr(N, "ngram_sets", lambda column, *a: cut.append(len(column)) or sets(column, *a))
    out = [d for b in N._sets(4, SimpleNamespace(value=wanted))(iter([batch])) for d in b.column("digest").to_pylist()]
    assert out == [digests[3], digests[7], digests[40]]
    assert cut == [3]


def test_links_of_nameless_and_repeated_ids(spark):
    import random

    from tests.llm.cases import words

    r = random.Random(8)
    rows = []
    for k in range(6):
        base = words(r, 80)
        ids = [None, None, None] if k < 2 else [1, 1, None] if k < 4 else [-(2**63), 2**63 - 1, 0]
        rows += [(i, " ".join(base[j:])) for j, i in enumerate(ids)]
    assert tuples(ngram_join(frame(spark, rows))) == brute(rows)


def test_registered_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert tuples(op4_ngram_join(spark, sf)) == brute(rows)


def test_one_of_each_group_stays(spark):
    rows = documents()
    component = {i: c for i, _, c in brute(rows, 5, 80) if i is not None}
    kept = [r["doc_id"] for r in distinct_documents(frame(spark, rows)).collect()]
    assert sorted(i for i in kept if i is not None) == sorted({i for i, c in component.items() if i == c})
    assert kept.count(None) == 2


def test_empty_table(spark):
    assert tuples(ngram_join(frame(spark, []))) == []
    assert distinct_documents(frame(spark, [])).count() == 0
