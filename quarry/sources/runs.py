"""Sharded runs of rows in a shared folder: deltas that are merged shard by shard.

Layout: ``<root>/v=<n>/shard=<xx>/part-*.parquet``. A commit writes its rows as
version n; it counts once the marker ``_COMMITTED`` is there, which lists the
bytes of each shard and, for merged shards, since which version they stand for
all earlier runs. So a plan never overwrites what it reads, and a lost executor
only re-runs tasks of the version being written.

Rows are dealt with a rebalance by shard: a large shard is written by several
tasks, small ones share a task. Merging is tiered by size and per shard: the
newest runs of a shard are merged as soon as there are more than ``most`` of
them, as far back as they aren't outweighed ``ratio`` times by the next older
run. Every row is so rewritten a number of times that grows with the logarithm
of the shard's size, and untouched shards aren't read. Versions of which no
shard counts any more are removed at the next merge; readers that began before
go on.

There is one writer at a time: a second one that picks the same version fails.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

SHARDS = 256             # about, that a root has
DEAL_BYTES = 64 << 20    # of rows that a task compares and writes


class Runs:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, shard: Column, most: int = 4, ratio: float = 2.0):
        """``shard``: a string column worked out from each row; ``schema`` doesn't hold it."""
        if most < 1 or ratio <= 0:
            raise ValueError("most: one or more; ratio: above zero")
        self.spark, self.root, self.schema, self.shard, self.most, self.ratio = spark, root.rstrip("/"), schema, shard, most, ratio
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- what is there ----

    def folders(self) -> dict[int, dict | None]:
        """Version to its marker; None for a version that isn't committed."""
        p, out = self._Path(self.root), {}
        if not self._fs.exists(p):
            return out
        for st in self._fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("v="):
                mark = self._Path(st.getPath(), "_COMMITTED")
                out[int(name[2:])] = self._told(mark) if self._fs.exists(mark) else None
        return out

    def _told(self, path) -> dict:
        stream = self._fs.open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def live(self, folders: dict | None = None) -> dict[str, list[int]]:
        """Shard to the versions that count, oldest first."""
        done = sorted((v, m) for v, m in (folders if folders is not None else self.folders()).items() if m is not None)
        out: dict[str, list[int]] = {}
        for v, m in done:
            for s in m["bytes"]:
                since = m["since"].get(s)
                out[s] = [w for w in out.get(s, []) if since is None or w < since] + [v]
        return out

    def version(self) -> int:
        return max((v for v, m in self.folders().items() if m is not None), default=0)

    def tokens(self) -> set:
        """Tokens of the commits that still have a folder."""
        return {m["token"] for m in self.folders().values() if m and m["token"] is not None}

    def read(self, columns: list | None = None, shards=None, runs: dict | None = None) -> DataFrame:
        """Rows of all runs that count, or of ``runs`` (shard to versions), with their version ``v`` and ``shard``."""
        fields = [f for f in self.schema.fields if columns is None or f.name in columns]
        extra = [T.StructField("v", T.IntegerType()), T.StructField("shard", T.StringType())]
        if runs is None:
            runs = self.live()
        paths = [f"{self.root}/v={v}/shard={s}" for s, versions in sorted(runs.items()) if shards is None or s in set(shards) for v in versions]
        schema = T.StructType(fields + extra)
        if not paths:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)
        if shards is not None:
            df = df.where(F.col("shard").isin(sorted(shards)))
        return df.select(*[f.name for f in fields], "v", "shard")

    # ---- changes ----

    def write(self, rows: DataFrame, token: str | None = None, since: dict | None = None, version: int | None = None, dealt: bool = False) -> int:
        """Rows as the next version; ``since``: shards for which it stands for all versions from that one on;
        ``dealt``: the rows come from :meth:`deal`, and aren't shuffled again."""
        v = version or max(self.folders(), default=0) + 1
        path = f"{self.root}/v={v}"
        if self._fs.exists(self._Path(path)):
            raise FileExistsError(f"{path}: another writer is at work")
        cols = [f.name for f in self.schema.fields]
        out = rows.select(*cols, "shard") if dealt else rows.select(*cols, self.shard.alias("shard")).hint("rebalance", "shard")
        out.write.mode("errorifexists").partitionBy("shard").parquet(path)
        size = {}
        for st in self._fs.listStatus(self._Path(path)):
            name = st.getPath().getName()
            if name.startswith("shard="):
                size[name[6:]] = self._fs.getContentSummary(st.getPath()).getLength()
        for s in since or {}:  # a shard of which nothing is left stands for its earlier runs too
            size.setdefault(s, 0)
            self._fs.mkdirs(self._Path(f"{path}/shard={s}"))
        out = self._fs.create(self._Path(path, "_COMMITTED"))
        try:
            out.write(json.dumps({"token": token, "bytes": size, "since": since or {}}).encode())
        finally:
            out.close()
        return v

    def deal(self, rows: DataFrame, key: str, size: int) -> DataFrame:
        """Rows dealt by ``shard``, with a column ``part``: a shard of a large load is shared by several tasks, but rows of a
        ``key`` (of which the shard is worked out) stay together. So what is compared per shard, part and key and then
        written is shuffled once. ``size``: about the bytes of the rows."""
        tasks = int(max(1, -(-size // DEAL_BYTES)))
        parts = F.pmod(F.xxhash64(key), F.lit(-(-tasks // SHARDS)))
        return rows.withColumns({"shard": self.shard, "part": parts}).repartition(tasks, "shard", "part")

    def due(self, folders: dict | None = None) -> dict[str, list[int]]:
        """Shard to the versions that should be merged now."""
        folders = self.folders() if folders is None else folders
        out = {}
        for s, versions in self.live(folders).items():
            if len(versions) <= self.most:
                continue
            size = [folders[v]["bytes"][s] for v in versions]
            at, held = len(versions) - 1, size[-1]
            while at > 0 and (len(versions) - at < 2 or size[at - 1] <= self.ratio * held):
                at -= 1
                held += size[at]
            out[s] = versions[at:]
        return out

    def merge(self, runs: dict[str, list[int]], fold: Callable[[DataFrame], DataFrame], dealt: bool = False) -> int:
        """Write the folded rows of the newest ``runs`` of some shards as one; the other shards stay as they are.
        ``dealt``: ``fold`` deals the rows itself."""
        folders = self.folders()
        since = {s: min(folders[v]["since"].get(s, v) for v in versions) for s, versions in runs.items()}
        v = self.write(fold(self.read(runs=runs)), since=since, dealt=dealt)
        live = {w for versions in self.live({**folders, v: {"bytes": dict.fromkeys(since, 0), "since": since}}).values() for w in versions}
        before = {w for versions in self.live(folders).values() for w in versions}
        for old, mark in folders.items():
            if mark is not None and old not in live and old not in before:  # nothing of it counted before this merge either
                self._fs.delete(self._Path(f"{self.root}/v={old}"), True)
        return v
