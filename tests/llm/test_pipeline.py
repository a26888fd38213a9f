import os
import subprocess
import sys
import textwrap

import corpus_pipeline as P
from tests.llm.cases import documents, frame
from tests.llm.test_decontamination import brute as contamination
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_secret_scans import base
from tokenforge.llm.shared import stored

ROOT = os.path.dirname(P.__file__)


def test_stages_one_after_the_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "mixing sources to target weights"]
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        docs, _ = stored(stage(spark, docs, sf), f"stage-{k}")
        assert docs.columns == columns
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(got) <= set(rows)
        if k == 0:
            known = [i for i in rows if i in labels]
            assert sum((i in got) == (labels[i]["quality"] == 1) for i in known) >= 0.9 * len(known)
        elif k == 1:
            assert set(got) == {c for _, _, c in components(list(rows.items()), 5, 80)}
        elif k == 2:
            hit = {r[0]: r for r in contamination(list(rows.items()), items)}
            for i, t in rows.items():
                if not hit[i][5]:
                    assert got[i] == t
                elif hit[i][2] > 0.5 * hit[i][1]:
                    assert i not in got
                else:
                    assert len(got[i]) < len(t)
        else:
            for i, t in rows.items():
                assert base(got[i]) == [] if base(t) else got[i] == t or "[SECRET]" in got[i]
        rows = got
    last = P.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in last} <= set(rows) and all(r["rate"] > 0 for r in last)


def test_run_gives_the_last_stage(spark, sf):
    out = P.run(spark, sf)
    assert {"doc_id", "n_tokens", "rate"} <= set(out.columns) and out.count() > 0


def tables(spark, folder, rows, items, labels):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_nulls_repeats_and_clashing_names(spark, tmp_path):
    rows = documents()
    labels = [(i, 1, 0) for i, _ in rows if i is not None and i % 3] + [(5, 0, 0), (6, 0, 1), (None, 1, 0), (10, None, None)]
    folder = tables(spark, f"file://{tmp_path}", rows, [(1, None), (2, "one two three")], labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        docs, _ = stored(stage(spark, docs, folder), f"odd-{k}")
        assert docs.columns == names
    got = {r["doc_id"] for r in docs.collect()}
    assert got <= {i for i, _ in rows} and docs.where("doc_id = 80").count() <= 1
    out = P.run(spark, folder)
    assert {"doc_id", "lang", "source", "n_tokens", "rate"} <= set(out.columns)


def test_empty_tables(spark, tmp_path):
    rows = [(1, "some words of a text"), (2, None), (3, "and others in another one")]
    out = P.run(spark, tables(spark, f"file://{tmp_path}/a", rows, [], []))
    assert sorted((r["doc_id"], r["rate"]) for r in out.collect()) == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert P.run(spark, tables(spark, f"file://{tmp_path}/b", [], [(1, "a b")], [(1, 1, 0)])).count() == 0


def test_entry_works_without_the_package(tmp_path):
    code = f"""
    import sys, importlib.abc
    sys.path.insert(0, {ROOT!r})
    class Gone(importlib.abc.MetaPathFinder):
        def find_spec(self, name, path, target=None):
            if name == "corpus_pipeline" or name.startswith("tokenforge.llm"):
                raise ModuleNotFoundError(name, name=name)
    sys.meta_path.insert(0, Gone())
    import __spark_entry__ as e
    assert "byte_freq" in e.queries() and not any(q.startswith("op") for q in e.queries()) and "pipeline" not in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=tmp_path)
