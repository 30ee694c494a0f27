"""Sharded runs: what a commit writes, what a merge rewrites, the store and the outcome state on top."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import meta
from quarry.operators import state
from quarry.operators.outcomes import fold_outcomes
from quarry.sources.runs import Runs
from quarry.sources.store import ENTRY_COLS, ResultStore
from quarry.streaming.ingest import LOG_SCHEMA, OutcomeState

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])


def runs(spark, tmp_path, **more):
    return Runs(spark, str(tmp_path / "r"), SCHEMA, F.substring("key", 1, 1), **more)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "key string, value long")


def newest(df):
    return df.groupBy("key").agg(F.max_by("value", "v").alias("value"))


def files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_merge_rewrites_the_shards_that_are_due_only(spark, tmp_path):
    r = runs(spark, tmp_path, most=2)
    r.write(rows(spark, [("a1", 1), ("b1", 1), ("c1", 1)]))
    r.write(rows(spark, [("a1", 2), ("a2", 2)]))
    assert r.due() == {} and r.live() == {"a": [1, 2], "b": [1], "c": [1]}
    r.write(rows(spark, [("a3", 3), ("b1", 3)]))
    assert r.due() == {"a": [1, 2, 3]}
    before = files(r.root)
    assert r.merge(r.due(), newest) == 4
    assert {f.split("/")[1] for f in files(r.root) - before} == {"shard=a"}
    assert r.live() == {"a": [4], "b": [1, 3], "c": [1]}
    assert sorted((x.key, x.value) for x in newest(r.read()).collect()) == [("a1", 2), ("a2", 2), ("a3", 3), ("b1", 3), ("c1", 1)]


def test_versions_without_a_live_shard_go_at_the_next_merge(spark, tmp_path):
    r = runs(spark, tmp_path, most=1, ratio=10.0)
    for k in range(6):
        r.write(rows(spark, [("a", k)]))
        if r.due():
            r.merge(r.due(), newest)
    assert len(r.folders()) <= 4 and len(r.live()["a"]) == 1
    assert newest(r.read()).collect()[0].value == 5


def test_a_large_run_is_not_rewritten_for_small_ones(spark, tmp_path):
    r = runs(spark, tmp_path, most=3, ratio=2.0)
    r.write(spark.range(200000).select(F.concat(F.lit("a"), F.sha1(F.col("id").cast("string"))).alias("key"), F.col("id").alias("value")))
    for k in range(4):
        r.write(rows(spark, [("a-small", k)]))
    assert r.due() == {"a": [2, 3, 4, 5]}
    r.merge(r.due(), newest)
    assert r.live() == {"a": [1, 6]}
    assert r.read().count() == 200001 and r.read().where("key = 'a-small'").first().value == 3


def test_rewriting_grows_with_the_logarithm(spark, tmp_path):
    r, rng, expected, written = runs(spark, tmp_path, most=2, ratio=1.0), random.Random(3), {}, 0
    for k in range(16):
        changes = {f"a{rng.randrange(10**6)}": k for _ in range(50)}
        expected |= changes
        r.write(rows(spark, list(changes.items())))
        if r.due():
            v = r.merge(r.due(), newest)
            written += r.read(runs={"a": [v]}).count()
    assert {x.key: x.value for x in newest(r.read()).collect()} == expected
    assert written <= 50 * 16 * 5  # rewriting all each time would be some 50 * 16 * 8


def test_a_shard_is_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        r = runs(spark, tmp_path)
        r.write(spark.range(300000).select(F.concat(F.when(F.col("id") % 100 == 0, "b").otherwise("a"), F.sha1(F.col("id").cast("string"))).alias("key"), F.col("id").alias("value")))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    parts = [f.split("/")[1] for f in files(r.root)]
    assert parts.count("shard=a") > 3 and parts.count("shard=b") <= 2


def test_a_version_without_its_marker_does_not_count(spark, tmp_path):
    r = runs(spark, tmp_path)
    r.write(rows(spark, [("a", 1)]))
    os.makedirs(f"{r.root}/v=2/shard=a")
    assert r.live() == {"a": [1]} and r.write(rows(spark, [("a", 3)])) == 3
    with pytest.raises(FileExistsError):
        r.write(rows(spark, [("a", 4)]), version=2)


def test_an_empty_root_and_an_empty_commit(spark, tmp_path):
    r = runs(spark, tmp_path)
    assert r.read().count() == 0 and r.live() == {} and r.version() == 0
    r.write(rows(spark, []))
    assert r.read().count() == 0 and r.version() == 1
    with pytest.raises(ValueError):
        runs(spark, tmp_path, most=0)


def entries(spark, values):
    at = dt.datetime(2024, 1, 1)
    made = [("main", k, 1, "good", "good", at, None, None, [], t, None, None) for k, t in values.items()]
    kinds = {"m_fail_ts": "timestamp", "c_fail_ts": "timestamp", "success_ts": "timestamp", "schema_version": "int", "properties": meta.PROPERTIES.simpleString()}
    return spark.createDataFrame(made, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in ENTRY_COLS))


def test_the_store_over_many_deltas(spark, tmp_path):
    store, rng, expected = ResultStore(spark, str(tmp_path / "s"), most=2), random.Random(5), {}
    for k in range(7):
        some = {f"{rng.choice(['00', '11', '22'])}{rng.randrange(12):02d}": f"text {k}" for _ in range(6)}
        some |= {f"{40 + k}": "alone"}  # a shard that no later commit touches
        expected |= some
        old = files(store.root)
        store.commit(entries(spark, some), strict=True)
        touched = {f.split("/")[1][6:] for f in files(store.root) - old}
        assert touched <= {s[:2] for s in some} | set(store.runs.live())
        assert f"{39 + k}" not in touched
    assert {r.sha1: r.text for r in store.state().collect()} == expected
    states = store.states().collect()
    assert sorted(r.sha1 for r in states) == sorted(expected) and all(len(v) <= 3 for v in store.runs.live().values())
    got = store.payload(["text"]).join(store.states().select("sha1", "v"), ["sha1", "v"]).collect()
    assert {r.sha1: r.text for r in got} == expected
    store.compact()
    assert {r.sha1: r.text for r in store.state().collect()} == expected and len(store._live()) == 1


def test_a_strict_commit_of_a_broken_entry_does_not_count(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"))
    store.commit(entries(spark, {"00aa": "x"}), strict=True)
    bad = entries(spark, {"00bb": "y"}).withColumn("m_state", F.lit("fail"))
    with pytest.raises(Exception, match="entry 00bb: contents_good_metadata_not_good, stamp_without_metadata_good"):
        store.commit(bad, strict=True)
    assert [r.sha1 for r in store.state().collect()] == ["00aa"]
    assert state.checked(entries(spark, {"00aa": "x"})).count() == 1


def log(spark, events):
    return spark.createDataFrame(events, LOG_SCHEMA)


def test_outcome_state_of_batches_with_late_and_repeated_records(spark, tmp_path):
    rng, at = random.Random(9), dt.datetime(2024, 1, 1)
    events = [(f"{rng.randrange(8):02d}key{rng.randrange(6)}", at + dt.timedelta(minutes=rng.randrange(500)), i, rng.choice(["full", "metadata"]),
               rng.choice(["success", "parser_failure", "service_failure"])) for i in range(300)]
    kept = OutcomeState(spark, str(tmp_path / "o"), most=2)
    for k in range(6):
        batch = events[k * 50:(k + 1) * 50] + (events[(k - 1) * 50:(k - 1) * 50 + 20] if k else [])
        kept.add(log(spark, batch), token=str(k))
        kept.add(log(spark, events[:10]), token=str(k))  # the same batch played again
    every = lambda df: sorted(map(str, df.collect()))
    assert every(kept.entries()) == every(fold_outcomes(log(spark, events)))
    assert kept.runs.read().count() <= 3 * 3 * 48  # three events a hash in at most three runs of its shard


def test_a_batch_writes_its_own_hashes_only(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    kept = OutcomeState(spark, str(tmp_path / "o"), most=8)
    kept.add(log(spark, [(f"{i:02d}", at, i, "full", "success") for i in range(90)]))
    before = files(kept.runs.root)
    kept.add(log(spark, [("05", at + dt.timedelta(days=1), 100, "full", "parser_failure")]))
    new = files(kept.runs.root) - before
    assert {f.split("/")[1] for f in new} == {"shard=05"}
    assert kept.runs.read(runs={"05": [2]}).count() == 1
    r = kept.entries().where("sha1 = '05'").first()
    assert (r.m_state, r.c_state) == ("good", "fail")


def test_hits_keep_their_texts_when_the_commit_merges_runs(spark, sf, tmp_path):
    """A batch with stored and new contents whose own commit merges the runs that hold the stored ones."""
    from quarry.operators.profiles import DEFAULTS, ProfileConfig
    from quarry.plans import pipeline
    from quarry.sources import fixtures

    config = ProfileConfig.from_dict({"*": {**DEFAULTS, "cache_file_backend": "main"}})
    f = fixtures.files(spark, sf)
    store = ResultStore(spark, str(tmp_path / "s"), most=1)
    told = lambda df: sorted((r.file_id, r.route, r.content, str(r.extracted_properties)) for r in df.collect())
    expected = told(pipeline.generate(spark, f, pipeline.Settings(config=config, now=dt.datetime(2025, 1, 1))))
    for files in (f.where("lang = 'en'"), f.where("lang in ('en', 'fr')"), f, f):
        got = pipeline.generate(spark, files, pipeline.Settings(config=config, now=dt.datetime(2025, 1, 1), store=store))
        got = told(got)
        assert all(r in expected for r in got)
    assert got == expected
    assert any(m and m["since"] for m in store.runs.folders().values())
