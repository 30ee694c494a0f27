"""The queries that have SQL, the pipeline, and where the subpackage stands in the library."""

import hashlib
import os
import pathlib
import re
import shutil
import subprocess
import sys

import duckdb
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from helpers import shingles, smallest
from quarry.llm import bpe, oracles, queries, stages
from quarry.llm.blocks import scratch
from test_llm_decontam import brute as windows
from test_llm_linededup import brute as lines

ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({oracles.SQL[name]})").fetchall()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in df.select(*columns).collect())


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf):
    docs = queries.table(spark, sf, "documents")
    columns, benchmark = docs.columns, [(r.item_id, r.text) for r in queries.table(spark, sf, "benchmark").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows(docs)
        path = scratch(spark, f"test-{name}")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        after = rows(docs)
        texts = {i: r.text for i, r in before.items()}
        if k < 4:
            assert docs.columns == columns
        if name == "language":
            assert len(after) >= 0.99 * len(before) and all(after[i] == before[i] for i in after)
        if name == "line_dedup":
            left = lines(list(texts.items()))
            assert {i: r.text for i, r in after.items()} == {i: t for i, t in left.items() if t.strip() or t == texts[i]}
            assert all(r.n_chars == (before[i].n_chars if r.text == texts[i] else len(r.text)) for i, r in after.items())
        if name == "near_duplicates":
            sets = {i: shingles(t, 5) for i, t in texts.items()}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert set(after) == {i for i, c in smallest(list(sets), links).items() if i == c}
        if name == "decontamination":
            assert set(after) == {i for i, (_, n, _) in windows(list(texts.items()), benchmark).items() if not n}
        if name == "bpe":
            library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
            assert {i: (r.n_tokens, r.decoded_sha256) for i, r in after.items()} == {
                i: (len(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items()}


def test_stages_on_odd_rows(spark, sf):
    text = " ".join(f"wort{i} und" for i in range(40))
    made = [(1, "der die das und " + text, "de", "s", 10), (2, None, None, None, None), (3, "", "de", "s", 0), (None, text, "de", "s", 1), (4, "12 34", "de", "s", 5),
            (5, "der die das und " + text, "de", "s", 10), (5, "der die das und " + text, "de", "s", 10), (6, "eins\n" + text, None, None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in made], "doc_id long, text string, lang string, source string, n_chars long, key string")
    for start in (docs, docs.limit(0)):
        now = start
        for _, stage in corpus_pipeline.STAGES:
            path = scratch(spark, "test-odd")
            stage(spark, now, sf).write.parquet(path)
            now = spark.read.parquet(path)
        assert (now.count() > 0) == (start is docs)


def test_nothing_else_imports_the_subpackage():
    for f in (ROOT / "quarry").rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"\bllm\b|corpus_pipeline", f.read_text()), f


def test_the_rest_works_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "quarry", tmp_path / "quarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) == set(q) and not [n for n in q if n.startswith('op')]; print('fine')"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}, timeout=120)
    assert out.stdout.strip().endswith("fine"), out.stderr[-500:]


def test_every_operator_has_its_query():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
    assert [f for _, f in corpus_pipeline.STAGES] == [stages.language, stages.lines, stages.near_duplicates, stages.decontamination, stages.encoding]
