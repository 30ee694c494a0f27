"""Streaming.

T1: new files are processed as they arrive. ``foreachBatch`` runs the batch
pipeline with the profiles' result stores as idempotent state and overwrites
the folder of its batch, so a replayed micro-batch (after a lost executor or a
restart from the checkpoint) extracts nothing new and leaves one copy of its
rows. T2: refresh is a batch run with expiry bounds set (see :func:`refresh`);
it works on the same stores. T3: an outcome log stream folded into the latest
state.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from quarry.functions.keys import shard
from quarry.operators.outcomes import fold_outcomes
from quarry.operators.profiles import ProfileConfig
from quarry.plans import pipeline
from quarry.session import work_dir
from quarry.sources import fixtures
from quarry.sources.runs import Runs
from quarry.sources.store import ResultStore

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def ingest(spark: SparkSession, stream: DataFrame, to_files, config: ProfileConfig, out_path: str,
           checkpoint: str, store: ResultStore | None = None, now: dt.datetime | None = None) -> None:
    """Run the pipeline on every micro-batch; ``out_path/batch_id=<n>`` gets
    the ``search_content`` rows ``(doc_id, sha1, route, content)`` of batch n."""
    def batch(df: DataFrame, batch_id: int) -> None:
        s = pipeline.Settings(config=config, store=store, now=now)
        g = pipeline.generate(spark, to_files(df), s)
        (g.select(F.col("file_id").alias("doc_id"), "sha1", "route", "content")
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    q = (stream.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def output(spark: SparkSession, out_path: str) -> DataFrame:
    """All rows written by :func:`ingest`; a row per file and batch it came in."""
    return spark.read.parquet(out_path).drop("batch_id")


def ingest_documents_stream(spark: SparkSession, sf_dir: str, config: ProfileConfig,
                            now: dt.datetime | None = None, source: str | None = None, base: str | None = None,
                            files_per_batch: int | None = 1) -> DataFrame:
    """T1 over the ``documents`` table, a file or a folder of part files, read as a file stream.

    ``base`` holds the checkpoint, the store and the outputs: a call with the ``base`` of an earlier one goes on with the
    files that have arrived since. ``files_per_batch``: None takes all that have arrived as one batch."""
    base = base or work_dir(spark, f"ingest-{uuid.uuid4().hex[:12]}")
    reader = spark.readStream.schema(DOC_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source or f"{sf_dir}/documents.parque[t]")  # a pattern: the table may be one file or a folder of them
    store = ResultStore(spark, base + "/store")
    ingest(spark, stream, fixtures.files_from, config, base + "/out", base + "/checkpoint", store=store, now=now)
    return output(spark, base + "/out")


def refresh(spark: SparkSession, files: DataFrame, config: ProfileConfig, store: ResultStore,
            success_before: dt.datetime | None = None, failure_before: dt.datetime | None = None,
            **settings) -> DataFrame:
    """Re-run the pipeline over a selection of files with expiry bounds that
    override the profiles' own (the later bound wins). What expired is extracted
    again and stored under the profiles' stores; returns the new outputs."""
    return pipeline.generate(spark, files, pipeline.Settings(
        config=config, store=store, success_before=success_before, failure_before=failure_before, **settings))


def decisive_events(log: DataFrame) -> DataFrame:
    """The at most three events per hash that decide its folded state: the latest
    M-deciding, C-deciding and success events, or the latest event of a hash that
    has none of them. Folding them gives the same state as folding the whole log,
    so they are the stream's bounded state."""
    ok = F.col("outcome") == "success"
    pf = F.col("outcome") == "parser_failure"
    full = F.col("request_kind") == "full"
    order = F.struct("ts", "event_id")
    ev = F.struct("ts", "event_id", "request_kind", "outcome")
    conds = [ok | (pf & ~full), full & (ok | pf), ok]
    agg = log.groupBy("sha1").agg(*[F.max_by(F.when(c, ev), F.when(c, order)).alias(f"e{i}")
                                    for i, c in enumerate(conds)], F.max_by(ev, order).alias("any"))
    found = F.array_distinct(F.array_compact(F.array("e0", "e1", "e2")))
    return agg.select("sha1", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array("any"))).alias("e")).select(
        "sha1", "e.ts", "e.event_id", "e.request_kind", "e.outcome")


LOG_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("sha1", T.StringType()), ("ts", T.TimestampType()), ("event_id", T.LongType()), ("request_kind", T.StringType()), ("outcome", T.StringType()))])


class OutcomeState:
    """The decisive events of an outcome log, in sharded runs.

    A batch writes the decisive events of its own hashes as a delta and reads
    nothing of what is kept; runs of a shard are merged, and reduced again, when
    too many have gathered. Folding the events of all runs gives the state,
    whatever the order in which records came: late ones are resolved by event
    time, repeated ones by event id.
    """

    def __init__(self, spark: SparkSession, root: str, most: int = 4, ratio: float = 2.0):
        self.runs = Runs(spark, root, LOG_SCHEMA, shard(F.col("sha1")), most, ratio)

    def add(self, log: DataFrame, token: str | None = None) -> None:
        """Commit a batch; one whose ``token`` is committed already (a batch that is played again) changes nothing."""
        if token is not None and token in self.runs.tokens():
            return
        self.runs.write(decisive_events(log), token=token)
        due = self.runs.due()
        if due:
            self.runs.merge(due, decisive_events)

    def entries(self) -> DataFrame:
        """The latest state per hash, as ``fold_outcomes`` gives it."""
        return fold_outcomes(self.runs.read().drop("v", "shard"))


def fold_outcome_stream(spark: SparkSession, log_stream: DataFrame, state_root: str, checkpoint: str, **settings) -> OutcomeState:
    """Fold an outcome-log stream into the latest state per hash, batch by batch."""
    kept = OutcomeState(spark, state_root, **settings)

    def batch(df: DataFrame, batch_id: int) -> None:
        kept.add(df.select(*LOG_SCHEMA.names), token=f"{checkpoint}#{batch_id}")  # batch numbers begin anew with another checkpoint

    (log_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return kept
