"""The output table and its change sets."""

import os

from quarry.functions import meta
from quarry.sources.outputs import SCHEMA, OutputTable

FIELDS = f"file_id bigint, sha1 string, content string, display {meta.FORMATTED.simpleString()}"


def load(spark, texts):
    show = lambda t: {"visible": [{"id": "a", "name": "A", "value": t[:3]}], "collapsed": []}
    return spark.createDataFrame([(i, f"s{t}", t, show(t) if t else None) for i, t in texts.items()], FIELDS)


def told(df):
    return {r.file_id: (r.change, r.content) for r in df.collect()}


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_change_sets(spark, tmp_path):
    out = OutputTable(spark, str(tmp_path / "o"))
    texts = {1: "one", 2: "two", 3: None, 4: "", 5: "five"}
    assert told(out.apply(load(spark, texts))) == {1: ("insert", "one"), 2: ("insert", "two"), 4: ("insert", ""), 5: ("insert", "five")}
    before = files(out.runs.root)
    assert told(out.apply(load(spark, texts))) == {} and files(out.runs.root) == before  # nothing changed, nothing written
    assert told(out.apply(load(spark, {1: "ONE", 2: None, 3: "three"}))) == {1: ("update", "ONE"), 2: ("remove", None), 3: ("insert", "three")}
    assert {r.file_id: r.content for r in out.rows().collect()} == {1: "ONE", 3: "three", 4: "", 5: "five"}
    assert told(out.apply(load(spark, {1: "ONE", 2: "two"}), complete=True)) == {2: ("insert", "two"), 3: ("remove", None), 4: ("remove", None), 5: ("remove", None)}
    assert {r.file_id: r.display.visible[0].value for r in out.rows().collect()} == {1: "ONE", 2: "two"}
    assert told(out.apply(load(spark, {}), complete=True)) == {1: ("remove", None), 2: ("remove", None)} and out.rows().count() == 0


def test_a_load_applied_twice_changes_nothing(spark, tmp_path):
    out = OutputTable(spark, str(tmp_path / "o"))
    first = told(out.apply(load(spark, {1: "one"}), token="b0"))
    out.apply(load(spark, {1: "uno", 2: "two"}), token="b1")
    assert told(out.apply(load(spark, {1: "one"}), token="b0")) == first
    assert {r.file_id: r.content for r in out.rows().collect()} == {1: "uno", 2: "two"}


def test_merges_drop_removals_and_keep_the_latest(spark, tmp_path):
    out, now = OutputTable(spark, str(tmp_path / "o"), most=1, ratio=1000.0), {}
    for k in range(5):
        now = {i: f"text {k} {i}" if (i + k) % 3 else f"text {i}" for i in range(k, k + 12)}
        out.apply(load(spark, now), complete=True)
        assert {r.file_id: r.content for r in out.rows().collect()} == now
    assert all(len(v) == 1 for v in out.runs.live().values())
    merged = {s for s, v in out.runs.live().items() if out.runs.folders()[v[0]]["since"].get(s)}
    kept = out.runs.read(["file_id", "change"], merged).collect()
    assert merged and all(r.change != "remove" for r in kept)
    assert [f.name for f in SCHEMA.fields][0] == "file_id"
