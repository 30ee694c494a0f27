"""Files of a shared folder without their contents in a row.

``listing`` lists files; ``hashed`` lets executors read each file in ranges and
feed one digest, so a file of any length is hashed in bounded memory;
:class:`PathIndex` remembers the hash of a path with its length and modification
time, so that only new and changed files are read; ``fetcher`` reads whole
contents for the files whose content must be extracted, one per distinct hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from quarry.functions.keys import shard
from quarry.sources.runs import Runs
from quarry.sources.tables import files_of

RANGE_BYTES = 8 << 20      # read at once
ROW_LIMIT = 1 << 30        # bytes of a content that may become a row
TASK_BYTES = 256 << 20     # of files that a task hashes
TASK_FILES = 10_000
TASK_FOLDERS = 100         # that a task lists

INDEX_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                             T.StructField("modified", T.TimestampType()), T.StructField("sha1", T.StringType())])


def place_of() -> Callable:
    """A function for executors: URI to (pyarrow file system, path in it)."""
    def place(uri: str):
        from pyarrow import fs

        scheme, _, rest = uri.partition(":")
        if "/" in scheme or not rest:
            return fs.LocalFileSystem(), uri
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")  # as Spark tells it: not percent-encoded
        authority, _, tail = rest.lstrip("/").partition("/")
        where, base = fs.FileSystem.from_uri(f"{scheme}://{authority}")
        return where, f"{base.rstrip('/')}/{tail}"

    return place


def stream_of() -> Callable:
    """A function that opens a URI for reading on an executor; a file system that pyarrow can't open needs another one."""
    place = place_of()

    def open_(uri: str):
        where, path = place(uri)
        return where.open_input_stream(path)

    return open_


def listing(spark: SparkSession, folder: str, mime_by_ending: dict | None = None) -> DataFrame:
    """All files below a folder with ``length`` and ``modified``; their contents aren't read.

    Executors list the folders, a level a round, so the driver holds no list of
    files; empty files are listed too (a scan of the folder would leave them
    out). Names that begin with ``_`` or ``.`` are passed over, as Spark does.
    """
    place = place_of()

    def run(frames: Iterator) -> Iterator:
        import pandas as pd
        from pyarrow import fs

        for f in frames:
            for uri in f["path"]:
                where, path = place(uri)
                found = [x for x in where.get_file_info(fs.FileSelector(path)) if not x.base_name.startswith(("_", "."))]
                for at in range(0, len(found), 10_000):
                    some = found[at:at + 10_000]
                    yield pd.DataFrame({
                        "path": [f"{uri.rstrip('/')}/{x.base_name}" for x in some], "is_folder": [x.type == fs.FileType.Directory for x in some],
                        "length": [x.size or 0 for x in some], "modified": pd.to_datetime([(x.mtime_ns or 0) // 1000 for x in some], unit="us", utc=True)})

    todo, found = spark.createDataFrame(pa.table({"path": [folder]})), None
    while True:
        level = todo.mapInPandas(run, "path string, is_folder boolean, length long, modified timestamp").checkpoint(eager=True)
        found = level if found is None else found.unionByName(level)
        todo = level.where("is_folder").select("path")
        n = todo.count()
        if not n:
            break
        todo = todo.repartition(max(-(-n // TASK_FOLDERS), min(n, spark.sparkContext.defaultParallelism)))  # few folders may hold many files
    told = files_of(found.where("not is_folder").select("path", F.struct("length", "modified").alias("content")), mime_by_ending)
    return told.select("file_id", "path", "mime", "has_native", "native_text", "native_meta", "content.length", "content.modified")


def hashed(files: DataFrame, range_bytes: int = RANGE_BYTES, open_stream: Callable | None = None) -> DataFrame:
    """``(path, sha1)`` of ``files`` (path, length), read in ranges. A file that can't be read ends the job."""
    open_ = open_stream or stream_of()

    def run(frames: Iterator) -> Iterator:
        import hashlib

        import pandas as pd

        for f in frames:
            out = []
            for path in f["path"]:
                digest = hashlib.sha1()
                with open_(path) as stream:
                    while part := stream.read(range_bytes):
                        digest.update(part)
                out.append(digest.hexdigest())
            yield pd.DataFrame({"path": f["path"], "sha1": out})

    dealt = files.select("path").repartition(_tasks(files), F.xxhash64("path"))
    return dealt.mapInPandas(run, "path string, sha1 string")


def _tasks(files: DataFrame) -> int:
    """Tasks for reading ``files`` (length): their rows are small, so Spark would give very many of them to one."""
    size = files.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    return int(max(1, -(-(size["bytes"] or 0) // TASK_BYTES), -(-size["n"] // TASK_FILES)))


def fetcher(files: DataFrame, row_limit: int = ROW_LIMIT, open_stream: Callable | None = None,
            frame_bytes: int = RANGE_BYTES) -> Callable[[DataFrame], DataFrame]:
    """Adds ``content`` to requests by their representative file ``rep``; null for a file above ``row_limit``,
    which an extractor may open by its ``path``. The files are dealt over tasks by number and length, and a task
    passes them on as frames of about ``frame_bytes``."""
    open_ = open_stream or stream_of()
    places = files.select(F.col("file_id").alias("rep"), "path", "length")

    def run(frames: Iterator) -> Iterator:
        for f in frames:
            rows, held, some = f.drop(columns="length"), 0, []
            for at, (path, length) in enumerate(zip(f["path"], f["length"]), 1):
                content = None
                if length <= row_limit:
                    with open_(path) as stream:
                        content = stream.read()
                    held += len(content)
                some.append(content)
                if held >= frame_bytes or at == len(f):  # contents can be large: a frame holds at most one beyond this
                    yield rows.iloc[at - len(some):at].assign(content=some)
                    held, some = 0, []

    def fetch(requests: DataFrame) -> DataFrame:
        j = requests.join(places, "rep")
        schema = T.StructType([f for f in j.schema.fields if f.name != "length"] + [T.StructField("content", T.BinaryType())])
        return j.repartition(_tasks(j), F.xxhash64("rep")).mapInPandas(run, schema)

    return fetch


class PathIndex:
    """Path to hash, kept in sharded runs; an entry holds for the length and modification time it was made for."""

    def __init__(self, spark: SparkSession, root: str, most: int = 4, ratio: float = 2.0):
        self.runs = Runs(spark, root, INDEX_SCHEMA, shard(F.sha1("path")), most, ratio)

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("path").agg(F.max_by(F.struct("length", "modified", "sha1"), "v").alias("e")).select("path", "e.*")

    def entries(self) -> DataFrame:
        """``(path, length, modified, sha1)``, the latest per path."""
        return self._latest(self.runs.read())

    def resolve(self, files: DataFrame, range_bytes: int = RANGE_BYTES, open_stream: Callable | None = None) -> DataFrame:
        """``files`` (path, length, modified, ...) with ``sha1`` and ``sha1_source``: ``index`` for known paths, which
        aren't opened, and ``computed`` for new and changed ones, which are read and remembered."""
        old = self.entries().select("path", F.col("length").alias("old length"), F.col("modified").alias("old modified"), F.col("sha1").alias("known"))
        same = (F.col("old length") == F.col("length")) & (F.col("old modified") == F.col("modified"))
        told = files.join(old, "path", "left").withColumn("known", F.when(same, F.col("known"))).drop("old length", "old modified").checkpoint(eager=True)
        unknown = told.where("known is null").select("path", "length", "modified")
        if not unknown.limit(1).count():
            return told.withColumn("sha1_source", F.lit("index")).withColumnRenamed("known", "sha1")
        read = hashed(unknown, range_bytes, open_stream).checkpoint(eager=True)  # no file is read again if an executor is lost
        self.runs.write(unknown.join(read, "path"))
        due = self.runs.due()
        if due:
            self.runs.merge(due, self._latest)
        j = told.join(read.withColumnRenamed("sha1", "computed"), "path", "left")
        return j.withColumn("sha1", F.coalesce("known", "computed")).withColumn(
            "sha1_source", F.when(F.col("known").isNotNull(), "index").otherwise("computed")).drop("known", "computed")
