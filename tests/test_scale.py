"""What keeps tasks, times and writes in proportion to the input."""

import glob

from pyspark.sql import functions as F

from quarry.plans import catalogue
from quarry.sources import files as S
from quarry.sources import fixtures, runs
from quarry.sources.outputs import OutputTable
from quarry.sources.runs import Runs

OUTPUT = ("file_id long, sha1 string, content string, display struct<visible: array<struct<id: string, name: string, value: string>>, "
          "collapsed: array<struct<id: string, name: string, value: string>>>")


def test_a_stash_is_written_and_parsed_once(spark, sf):
    """Catalyst must not repeat the parse in a filter that it makes of an explode, nor write a value twice to take its length."""
    plan = catalogue.q_unstash(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") == 1
    assert plan.count("StructsToJson") + plan.count("to_json(") == 3  # a name, a list, a value


def test_a_batch_arrives_in_files_of_several_tasks(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").repartition(4)
    told = [sorted(glob.glob(f"{folder}/arrival=*")) for folder in fixtures.arriving(docs, "doc_id", str(tmp_path / "in"), 3, again=F.col("doc_id") < 10)]
    assert [len(x) for x in told] == [1, 2, 3]  # one arrives after the other
    assert all(len(glob.glob(f"{arrival}/part-*")) > 1 for arrival in told[-1])
    got = spark.read.parquet(str(tmp_path / "in"))
    assert sorted(r.doc_id for r in got.collect()) == sorted([r.doc_id for r in docs.collect()] + list(range(10)))
    times = got.where("doc_id < 10").groupBy("doc_id").agg(F.sort_array(F.collect_list("arrival")).alias("a")).collect()
    assert {tuple(r.a) for r in times} <= {(0, 1), (1, 2), (0, 2)}


def test_contents_are_fetched_by_several_tasks(spark, tmp_path, monkeypatch):
    """Requests are small, so without a number of tasks of their own all files of a load are read by one or two."""
    for i in range(60):
        (tmp_path / f"{i:02}.txt").write_bytes(b"" if i == 7 else str(i).encode() * (i + 1))
    monkeypatch.setattr(S, "TASK_FILES", 10)
    files = S.listing(spark, str(tmp_path)).checkpoint()
    requests = files.select(F.col("file_id").alias("rep"), F.lit("full").alias("request_kind"))
    got = S.fetcher(files, row_limit=100, frame_bytes=50)(requests).select("path", "content", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in got}) > 3
    expected = {f"{i:02}.txt": b"" if i == 7 else None if i > 49 else str(i).encode() * (i + 1) for i in range(60)}
    assert {r.path[-6:]: r.content if r.content is None else bytes(r.content) for r in got} == expected and len(got) == 60


def test_an_output_is_shuffled_once_to_be_compared_and_written(spark, tmp_path, monkeypatch):
    plan, plans, write = lambda df: df._jdf.queryExecution().executedPlan().toString(), [], Runs.write
    monkeypatch.setattr(Runs, "write", lambda self, rows, *a, **kw: (plans.append(plan(rows) + ("" if kw.get("dealt") else "Exchange rebalance")), write(self, rows, *a, **kw))[1])
    out = OutputTable(spark, str(tmp_path / "out"), most=1)
    load = lambda texts: spark.createDataFrame([(i, f"s{i}", t, None) for i, t in texts.items()], OUTPUT)
    out.apply(load({i: f"text {i}" for i in range(300)}), complete=True)
    second = {i: f"text {i}" + (" new" if i % 5 == 0 else "") for i in range(100, 320)} | {101: None, 400: None}
    changes = out.apply(load(second), complete=True)
    assert [p.count("Exchange ") for p in (plans[0], plans[-1])] == [1, 1] and len(plans) == 3  # the first load, and the merge after the second
    assert "Exchange " not in plan(out.rows())  # one run a shard: nothing to compare
    assert {r.file_id: r.content for r in out.rows().collect()} == {i: t for i, t in second.items() if t}
    told = {r.file_id: r.change for r in changes.collect()}
    assert told == {i: "remove" for i in [*range(100), 101]} | {i: "update" for i in range(100, 300, 5)} | {i: "insert" for i in range(300, 320)}


def test_a_large_load_is_dealt_over_tasks_and_files_stay_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "SHARDS", 4)
    rows = spark.range(1000).withColumnRenamed("id", "file_id")
    rows = rows.unionByName(rows)
    dealt = OutputTable(spark, str(tmp_path / "out")).runs.deal(rows, "file_id", 40 * runs.DEAL_BYTES).withColumn("task", F.spark_partition_id())
    assert dealt.agg(F.max("part")).first()[0] == 9 and dealt.select("task").distinct().count() > 20
    assert dealt.groupBy("file_id").agg(F.count_distinct("task").alias("n"), F.count("*").alias("rows")).where("n <> 1 or rows <> 2").count() == 0
