"""The stages on the smallest tables, each against a plain version on its own input."""

from __future__ import annotations

import os
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import ROOT, SMALL
from pyspark.sql import functions as F
from test_jaccard import brute as groups
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from paperloom.llm import mixing, queries, toxicity
from paperloom.session import materialize


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of every stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), name)
        out[name] = docs
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 5 and all(stages[n].schema == stages["documents"].schema for n in names[:-1])


def test_toxic_rows_go(spark, stages):
    model = queries.toxic_model(spark, SMALL)
    want = [r for r in rows(stages["documents"]) if sum(p >= 0.5 for p in model.probabilities(r[1])) == 0]
    assert rows(stages["toxicity"]) == want


def test_one_row_of_each_group_stays(stages):
    before = [(r["doc_id"], r["text"]) for r in stages["toxicity"].collect()]
    want = sorted({g[1] for g in groups(before)})
    assert sorted(r["doc_id"] for r in stages["near_copies"].collect()) == want and len(want) < len(before)


def test_benchmark_rows_go(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = rows(stages["near_copies"]), rows(stages["decontamination"])
    gone = [r for r in before if r not in after]
    assert set(after) <= set(before) and all(any(t in r[1] for t in items) for r in gone)
    assert not any(t in r[1] for r in after for t in items)


def test_mix_meets_its_targets(stages):
    size = lambda t: len((t or "").encode().split())
    before = {r["doc_id"]: r for r in stages["decontamination"].collect()}
    sizes = Counter()
    for r in before.values():
        sizes[r["source"]] += size(r["text"])
    names = sorted(sizes)
    goal = dict(zip(names, mixing.targets([sizes[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])))
    taken, each = Counter(), Counter()
    for r in stages["mixing"].collect():
        taken[r["source"]] += size(r["text"])
        each[r["doc_id"]] += size(r["text"])
        assert r["text"] in before[r["doc_id"]]["text"] or size(r["text"]) < size(before[r["doc_id"]]["text"])
    assert all(abs(taken[s] - goal[s]) <= 3 * mixing.BLOCK for s in names)
    assert all(n <= 3 * size(before[i]["text"]) for i, n in each.items())


def test_tokens_of_the_last_stage(stages):
    library = Tokenizer.from_file(queries.vocabulary())
    want = Counter()
    for r in stages["mixing"].collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
    got = sorted(stages["token_files"].collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])[:-1]]).tolist()
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)


def test_rerun_agrees(spark, stages):
    assert rows(pipeline.run(spark, SMALL)) == rows(stages["token_files"])


def test_stages_take_odd_tables(spark, stages):
    schema = stages["documents"].schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
                                 (2, "two words", None, None, 9), (3, "word " * 9_000, "en", "a", None)], schema)
    for docs, ids in ((odd, [1, 2, 3, None]), (odd.limit(0), [])):
        for name, stage in pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SMALL), name)
            assert docs.schema == schema
            got = [r["doc_id"] for r in docs.select("doc_id").collect()]
            if name in ("toxicity", "near_copies", "decontamination"):
                assert sorted(set(got), key=str) == ids  # nothing clean goes
            else:
                assert set(got) <= set(ids) and (3 in got or not ids)
        tokens = pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
        assert len(tokens) == docs.count() and all(r["n_tokens"] >= 1 for r in tokens)


def test_the_rest_imports_without_these_operators(tmp_path):
    for name in ("paperloom", "__spark_entry__.py"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name) if name.endswith("py") else None
    os.mkdir(tmp_path / "paperloom")
    for name in os.listdir(os.path.join(ROOT, "paperloom")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "paperloom", name), tmp_path / "paperloom" / name)
    code = ("import sys, shutil; sys.path.insert(0, '.'); import __spark_entry__ as e; "
            "q = e.queries(); assert q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q)")
    # The entry file looks beside its real place first, so it is copied.
    entry = open(tmp_path / "__spark_entry__.py", encoding="utf-8").read()
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(entry)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr[-800:]


def test_nothing_else_imports_these_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "paperloom")):
        for name in files:
            if name.endswith(".py") and f"{os.sep}llm" not in folder:
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert not re.search(r"^\s*(?:from|import)\s+(?:[\w.]*\bllm\b|corpus_pipeline)", text, re.M), name
