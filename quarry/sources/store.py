"""Result store (S3 S4 S5 S9): typed Parquet, written as deltas.

The entries lie in :class:`quarry.sources.runs.Runs`, sharded by the first two
characters of the hash: a commit writes the changed entries only, and runs are
merged shard by shard when too many have gathered. For a key, the entry of the
latest version holds.

:meth:`ResultStore.states` reads keys and state columns alone, and only the
shards asked for; payload columns are read by :meth:`ResultStore.payload`. A
shard with one run is read as it is. A merge finds the replaced entries by keys
and versions alone, and then rewrites the others without sorting or grouping
their texts.

On a cluster with a transactional table format the same upsert is a
``MERGE INTO ... ON (store, sha1)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from quarry.functions import meta
from quarry.functions.keys import shard
from quarry.operators.state import checked
from quarry.sources.runs import Runs

STORE_SCHEMA = T.StructType([
    T.StructField("store", T.StringType()),
    T.StructField("sha1", T.StringType()),
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("m_state", T.StringType()),
    T.StructField("c_state", T.StringType()),
    T.StructField("success_ts", T.TimestampType()),
    T.StructField("m_fail_ts", T.TimestampType()),
    T.StructField("c_fail_ts", T.TimestampType()),
    T.StructField("properties", meta.PROPERTIES),
    T.StructField("text", T.StringType()),
    T.StructField("m_message", T.StringType()),
    T.StructField("c_message", T.StringType()),
])
ENTRY_COLS = [f.name for f in STORE_SCHEMA.fields]


KEY = ["store", "sha1"]
PAYLOAD = ["properties", "text", "m_message", "c_message"]
STATE = [c for c in ENTRY_COLS if c not in (*KEY, *PAYLOAD)]


class ResultStore:
    """``compact_after``: merge the whole store when more versions than that count; None: only shards that are due."""

    def __init__(self, spark: SparkSession, root: str, compact_after: int | None = None, most: int = 4, ratio: float = 2.0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.compact_after = compact_after
        self.runs = Runs(spark, root, STORE_SCHEMA, shard(F.col("sha1")), most, ratio)

    def _folders(self) -> dict:
        """Version to its marker; every version folder, committed or not."""
        return self.runs.folders()

    def _live(self) -> list[int]:
        """Versions of which a shard counts."""
        return sorted({v for versions in self.runs.live().values() for v in versions})

    def version(self) -> int:
        return max(self._live(), default=0)

    def _parts(self, columns: list, shards: list | None, live: dict | None = None) -> tuple[DataFrame, DataFrame | None]:
        """Rows of the shards with one run, and of those with several (None if there are none)."""
        live = {s: v for s, v in (self.runs.live() if live is None else live).items() if shards is None or s in set(shards)}
        many = {s: v for s, v in live.items() if len(v) > 1}
        alone = self.runs.read(columns, shards, {s: v for s, v in live.items() if s not in many})
        return alone, self.runs.read(columns, shards, many) if many else None

    def states(self, shards: list | None = None, live: dict | None = None) -> DataFrame:
        """S3, keys and states: ``(store, sha1, <state columns>, v)`` of the current entries, or of those of the runs ``live``."""
        alone, many = self._parts(KEY + STATE, shards, live)
        alone = alone.select(*KEY, *STATE, "v")
        if many is None:
            return alone
        return alone.unionByName(many.groupBy(*KEY).agg(F.max_by(F.struct(*STATE, "v"), "v").alias("e")).select(*KEY, "e.*"))

    def payload(self, columns: list, shards: list | None = None, live: dict | None = None) -> DataFrame:
        """``(store, sha1, v, <columns>)`` of every run: join it with the ``v`` of :meth:`states`, read with the same ``live``
        (``runs.live()``) if a commit comes between, which may merge runs; those merged are kept up to the next merge."""
        return self.runs.read(KEY + list(columns), shards, live).drop("shard")

    @staticmethod
    def _current(rows: DataFrame) -> DataFrame:
        """Rows that no later version of their key replaces; keys and versions are compared, the rest is not shuffled unless many are replaced."""
        last = rows.groupBy(*KEY).agg(F.max("v").alias("last"), F.count("*").alias("n")).where("n > 1").select(*[F.col(k).alias(f"l_{k}") for k in KEY], "last")
        return rows.join(last, F.col("store").eqNullSafe(F.col("l_store")) & (F.col("sha1") == F.col("l_sha1")) & (F.col("v") < F.col("last")), "left_anti")

    def state(self) -> DataFrame:
        """S3: current entries with their payload (empty frame for a new store)."""
        alone, many = self._parts(ENTRY_COLS, None)
        alone = alone.select(*ENTRY_COLS)
        return alone if many is None else alone.unionByName(self._current(many).select(*ENTRY_COLS))

    def _write(self, df: DataFrame, markers: list | None = None) -> int:
        return self.runs.write(df, version=max(self._folders(), default=0) + 1)

    def commit(self, changes: DataFrame, strict: bool = False) -> int:
        """Upsert changed entries by (store, sha1).

        The new record replaces the old one; contents are kept only while
        C is good (P11: expiry and failures delete stored text). ``strict``:
        an entry that breaks an invariant (F8) ends the commit; nothing of it counts then.
        """
        ch = changes.select(*ENTRY_COLS).withColumn("text", F.when(F.col("c_state") == "good", F.col("text")))
        v = self._write(checked(ch) if strict else ch)
        if self.compact_after is not None:
            return self.compact() if len(self._live()) > self.compact_after else v
        due = self.runs.due()
        return self.runs.merge(due, self._current) if due else v

    def compact(self) -> int:
        """Merge every shard into one run."""
        live = self.runs.live()
        return self.runs.merge(live, self._current) if live else 0
