"""The table of outputs per file, changed by what a load changes only.

:class:`OutputTable` compares the outputs of a load with those written before by
digest, and writes a change set: new and changed rows, and removals of files
whose text has become null or, for a complete load, that weren't in it.
Unchanged rows aren't written, and their outputs aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from quarry.functions import meta
from quarry.functions.keys import shard
from quarry.sources.runs import Runs

SCHEMA = T.StructType([T.StructField("file_id", T.LongType()), T.StructField("sha1", T.StringType()), T.StructField("content", T.StringType()),
                       T.StructField("display", meta.FORMATTED), T.StructField("digest", T.StringType()), T.StructField("change", T.StringType())])
OUTPUTS = ["sha1", "content", "display"]
PLACE = ["shard", "part", "file_id"]
PACKED = 4  # bytes of rows for a byte of their files, about


class OutputTable:
    def __init__(self, spark: SparkSession, root: str, most: int = 4, ratio: float = 2.0):
        self.runs = Runs(spark, root, SCHEMA, shard(F.sha1(F.col("file_id").cast("string"))), most, ratio)

    def _kept(self, columns: list) -> DataFrame:
        """The latest row per file, removals included. Shards with one run are read as they are."""
        live = self.runs.live()
        alone = self.runs.read(["file_id", *columns], runs={s: v for s, v in live.items() if len(v) == 1}).select("file_id", *columns)
        many = {s: v for s, v in live.items() if len(v) > 1}
        return alone.unionByName(self._latest(self.runs.read(["file_id", *columns], runs=many), columns)) if many else alone

    @staticmethod
    def _latest(rows: DataFrame, columns: list) -> DataFrame:
        last = rows.groupBy("file_id").agg(F.max("v").alias("last"), F.count("*").alias("n")).where("n > 1").select(F.col("file_id").alias("l_id"), "last")
        return rows.join(last, (F.col("file_id") == F.col("l_id")) & (F.col("v") < F.col("last")), "left_anti").select("file_id", *columns)

    def _merge(self, due: dict) -> None:
        """Merge runs: of the rows of a file the latest stays. A row is shuffled once, to be compared and written there."""
        folders, live = self.runs.folders(), self.runs.live()
        whole = sorted(s for s, versions in live.items() if due.get(s) == versions)  # removals have done their work there
        size = PACKED * sum(folders[v]["bytes"][s] for s, versions in due.items() for v in versions)

        def fold(rows: DataFrame) -> DataFrame:
            last = F.max("v").over(Window.partitionBy(*PLACE))
            newest = self.runs.deal(rows, "file_id", size).withColumn("last", last).where("v = last")
            return newest.where((F.col("change") != "remove") | ~F.col("shard").isin(whole))

        self.runs.merge(due, fold, dealt=True)

    def rows(self) -> DataFrame:
        """``(file_id, sha1, content, display)`` of all files that have outputs."""
        return self._kept([*OUTPUTS, "change"]).where("change <> 'remove'").drop("change")

    def apply(self, generated: DataFrame, complete: bool = False, token: str | None = None) -> DataFrame:
        """Write what ``generated`` (file_id and :data:`OUTPUTS`, a row per file) changes; returns the change set
        ``(file_id, change, sha1, content, display)`` with the changes ``insert``, ``update`` and ``remove``.

        A file without text has no row. ``complete``: files that aren't in
        ``generated`` are removed. A load whose ``token`` was applied before (a
        replayed batch) changes nothing and returns the change set written then.
        """
        done = {m["token"]: v for v, m in self.runs.folders().items() if m}
        if token is None or token not in done:
            digest = F.sha2(F.concat_ws("|", F.coalesce("sha1", F.lit("")), F.octet_length("content").cast("string"), "content", F.to_json("display")), 256)
            # generated outputs come from a whole pipeline: they are written once, and read for the comparison and the change set
            new = generated.select(F.col("file_id").cast("long").alias("file_id"), *OUTPUTS, digest.alias("digest")).where("file_id is not null").checkpoint(eager=True)
            old = self._kept(["digest", "change"]).where("change <> 'remove'").select("file_id", F.col("digest").alias("old"))
            both = new.withColumn("given", F.lit(True)).unionByName(old.withColumn("given", F.lit(False)), allowMissingColumns=True)
            size = new.agg(F.sum(F.octet_length("content"))).first()[0] or 0
            # the rows of a file, at most a given one and an old one, meet where they are written: an output is shuffled once
            file = Window.partitionBy(*PLACE)
            there = F.col("given") & F.col("content").isNotNull()
            told = self.runs.deal(both, "file_id", size).withColumns({
                "old": F.max("old").over(file), "any given": F.max("given").over(file), "any there": F.max(there).over(file)})
            gone = ~F.col("given") & ~F.col("any there") & (F.col("any given") | F.lit(complete))
            change = F.when(there & F.col("old").isNull(), "insert").when(there & (F.col("digest") != F.col("old")), "update").when(gone, "remove")
            v = self.runs.write(told.withColumn("change", change).where("change is not null"), token=token, dealt=True)
            written = {s: [v] for s in self.runs.folders()[v]["bytes"]}
            due = self.runs.due()
            if due:
                self._merge(due)
        else:
            written = {s: [done[token]] for s in self.runs.folders()[done[token]]["bytes"]}
        return self.runs.read(runs=written).select("file_id", "change", *OUTPUTS)
