"""Trie of conversation prefixes with totals over subtrees by depth bands.

A node is a distinct sequence of the first d turns (role, text); the textless
root is the node of depth 0. A conversation is a path: at each depth its node's
key is the running XOR of 128-bit hashes of (depth, role, text), so a key is
found without its ancestors, the parent's key is the key without the last turn,
and a conversation of any length is worked on by several tasks.

Totals over subtrees (leaves, saved text) go up in bands of ``band`` depths. A
node is exploded only to its ancestors inside its band, at most ``band`` rows;
they are found on the path of the smallest conversation through the node. The
band roots then form a trie of a ``band``-th of the depth, whose totals are
worked out in the same way; a completed band root adds its total to the nodes
of the band above it. So a chain of depth D takes log(D) / log(band) rounds, and
no round makes more than ``band`` rows of one.

Turns are ranked, and keys accumulated, by sorted ranges of rows: each task
writes running values of its range, and the driver adds up the ends of the
ranges, one row a task. Nodes with very many conversations are combined before
the shuffle; the list of conversations that end in a node is hashed in parts.

Defined results: a null role or text is empty; a null turn comes first, and
turns of the same number are ordered by role and text; repeated rows are turns
of their own; a row without a conversation id belongs to no conversation; a
conversation without turns ends in the root; other columns are not looked at;
an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quarry.llm.blocks import scratch

BAND = 16
PART_IDS = 1 << 14   # conversation ids hashed as one part
KEY = ("depth", "k1", "k2")
COMBINE = {"add": np.add, "xor": np.bitwise_xor}


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running(rows: DataFrame, key: str, order: list[Column], ranges: list[Column], values: list[str], how: str) -> DataFrame:
    """``rows`` with the ``values`` (long) accumulated in ``order`` inside each ``key`` (long, not null).

    ``ranges`` deals the rows to tasks and must agree with ``order``. A key may
    reach over any number of tasks. The values at the end of each task's range,
    one row a task, pass through the driver.
    """
    spark = rows.sparkSession
    combine, own = COMBINE[how], rows.columns
    dealt = rows.repartitionByRange(F.col(key), *ranges).sortWithinPartitions(F.col(key), *order)
    schema = T.StructType([*rows.schema, T.StructField("part", T.LongType()), T.StructField("row", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, open_key, before = TaskContext.get().partitionId(), 0, None, {}
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(key).to_numpy()
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            start = np.flatnonzero(first)
            run_of = np.cumsum(first) - 1
            columns = {n: b.column(n) for n in own}
            for v in values:
                x = columns[v].to_numpy().astype(np.int64)
                if keys[0] == open_key:
                    x[0] = combine(x[0], before[v])
                up = combine.accumulate(x)
                base = np.zeros(len(start), np.int64)
                base[1:] = up[start[1:] - 1]
                up = up ^ base[run_of] if how == "xor" else up - base[run_of]
                columns[v], before[v] = pa.array(up), up[-1]
            open_key = keys[-1]
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(np.full(b.num_rows, part, np.int64)), pa.array(row + np.arange(b.num_rows))], names=schema.names)
            row += b.num_rows

    table = _written(dealt.mapInArrow(run, schema), "running")
    ends = table.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct("row", key, *values)).alias("last")).orderBy("part").collect()
    carried, held = [], None  # held: key and values of the run that is open at the end of the part before
    for r in ends:
        last = [r["last"][v] for v in values]
        if held is not None and held[0] == r["first"]:
            carried.append((r["part"], r["first"], *held[1]))
            if r["first"] == r["last"][key]:
                last = [int(combine(np.int64(a), np.int64(b))) for a, b in zip(held[1], last)]
        held = (r["last"][key], last)
    names = ["part", key, *(f"{v} carried" for v in values)]
    carry = spark.createDataFrame(pa.table({n: pa.array([c[i] for c in carried], pa.int64()) for i, n in enumerate(names)}))  # one row a task at most
    joined = table.join(F.broadcast(carry), ["part", key], "left")
    added = {v: (lambda a, b: a.bitwiseXOR(b) if how == "xor" else a + b)(F.col(v), F.coalesce(F.col(f"`{v} carried`"), F.lit(0))) for v in values}
    return joined.select(*(added[c].alias(c) if c in added else F.col(c) for c in own))


def ordered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, pos, digest, n_bytes)``: every turn's place in its conversation (from 1), its content's digest, and bytes of its text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"),
                     F.lit(1).cast("long").alias("pos")).where("conv_id is not null")
    ranked = running(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
                     [F.col("turn").asc_nulls_first(), F.substring(F.concat("role", F.lit("\0"), F.substring("text", 1, 64)), 1, 64)], ["pos"], "add")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return ranked.select("conv_id", "pos", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))


def with_shared_heads(turns: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(conversations ``(conv_id)``, their turns ``(conv_id, depth, digest, n_bytes)``), rebuilt.

    Conversation c begins with the first h turns of conversation ``c - c % group``
    (as many as it has) and goes on with its own after its first h; h is
    ``crc32(c) % (most + 1)``.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % (most + 1)
    convs = _written(turns.groupBy("conv_id").agg(F.max("pos").alias("n")).select("conv_id", "n", h.alias("h"), (c - c % group).alias("base")), "conversations")
    heads = turns.where(F.col("pos") <= most).select(c.alias("base"), F.col("pos").alias("depth"), "digest", "n_bytes")
    borrowed = convs.select("conv_id", "h", "base").join(heads, "base").where("depth <= h").select("conv_id", "depth", "digest", "n_bytes")
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    short = convs.join(sizes, "base", "left").select("conv_id", (F.col("h") - F.coalesce("base_n", F.lit(0))).alias("lacking")).where("lacking > 0")
    own = turns.where(F.col("pos") > h).join(short, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("lacking", F.lit(0))).alias("depth"), "digest", "n_bytes")
    return convs.select("conv_id"), borrowed.unionByName(own)


def _rolled_up(values: DataFrame, paths: DataFrame, band: int, height: int) -> DataFrame:
    """``(depth, k1, k2, conv_id, n_leaves, saved)``: sums of the ``values`` of every node over its subtree.

    ``paths``: (conv_id, depth, k1, k2) of the conversations; ``conv_id`` of a
    node is one whose path runs through it.
    """
    over = F.expr(f"depth div {band}")
    totals = (F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    places = paths.select("conv_id", over.alias("band"), *KEY)
    inside = values.select("conv_id", over.alias("band"), F.col("depth").alias("from"), "n_leaves", "saved").join(places, ["conv_id", "band"]).where("depth <= from")
    summed = _written(inside.groupBy(*KEY).agg(F.max(F.when(F.col("depth") == F.col("from"), F.col("conv_id"))).alias("conv_id"), *totals), "band-totals")
    if height < band:
        return summed
    root, up = F.col("depth") % band == 0, over.alias("depth")
    done = _rolled_up(summed.where(root).select(up, "k1", "k2", "conv_id", "n_leaves", "saved"), paths.where(root).select("conv_id", up, "k1", "k2"), band, height // band)
    lifted = done.where("depth > 0").select("conv_id", (F.col("depth") - 1).alias("band"), "n_leaves", "saved").join(places, ["conv_id", "band"])
    none = F.lit(None).cast("long").alias("conv_id")
    both = summed.select(*KEY, "conv_id", "n_leaves", "saved").unionByName(lifted.select(*KEY, none, "n_leaves", "saved"))
    return _written(both.groupBy(*KEY).agg(F.max("conv_id").alias("conv_id"), *totals), "subtree-totals")


def _digests(ends: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)`` of ``(conv_id, depth, k1, k2)``: SHA-256 of the ascending ids, joined by commas."""
    part = T.StructType([*(T.StructField(k, T.LongType()) for k in KEY), T.StructField("part", T.LongType()), T.StructField("ids", T.StringType())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40  # ranges of rows are in order
        for whole in batches:
            for b in (whole.slice(i, PART_IDS) for i in range(0, whole.num_rows, PART_IDS)):
                keys = np.stack([b.column(k).to_numpy() for k in KEY])
                start = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
                ids = pa.ListArray.from_arrays(pa.array(np.append(start, b.num_rows), pa.int32()), b.column("conv_id").cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*(pa.array(k[start]) for k in keys), pa.array(at + np.arange(len(start))), pa.compute.binary_join(ids, ",")], names=part.names)
                at += len(start)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, digest = None, None
        names = [*KEY, "ends_sha256"]
        for b in batches:
            done = []
            for *key, ids in zip(*(b.column(k).to_pylist() for k in (*KEY, "ids"))):
                if key == open_:
                    digest.update(b"," + ids.encode())
                    continue
                if open_ is not None:
                    done.append([*open_, digest.hexdigest()])
                open_, digest = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=names)
        if open_ is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*open_, digest.hexdigest())], names=names)

    parts = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").select(*KEY, "conv_id").mapInArrow(joined, part)
    return parts.repartition(*KEY).sortWithinPartitions(*KEY, "part").mapInArrow(hashed, T.StructType([*part[:3], T.StructField("ends_sha256", T.StringType())]))


def trie(convs: DataFrame, turns: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of the trie of ``turns`` (conv_id, depth, digest, n_bytes) of the conversations ``convs`` (conv_id, distinct).

    ``conv_id``: its smallest conversation; ``parent_conv_id``; ``n_convs``:
    conversations through it; ``n_children``; ``n_leaves``: childless nodes of
    its subtree; ``saved_tokens``: over its subtree, bytes of a node's last text
    times its conversations but one; ``ends_sha256`` of the ids that end in it.
    """
    if band < 2:
        raise ValueError("a band has two depths at least")
    one = [F.xxhash64(F.lit(seed), F.col("depth"), F.col("digest")) for seed in (1, 2)]
    rows = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "n_bytes", *(t.alias(f"t{i}") for i, t in enumerate(one, 1)),
                        *(t.alias(f"k{i}") for i, t in enumerate(one, 1)))
    keyed = running(rows, "conv_id", [F.col("depth")], [F.col("depth")], ["k1", "k2"], "xor")
    zero = F.lit(0).cast("long")
    start = convs.select("conv_id", zero.alias("depth"), zero.alias("n_bytes"), *(zero.alias(x) for x in ("t1", "t2", "k1", "k2")))
    places = _written(keyed.unionByName(start), "prefixes")
    xor = lambda i: F.max(F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}"))).alias(f"p{i}")
    nodes = places.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), xor(1), xor(2))
    nodes = _written(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = _written(nodes.join(children, list(KEY), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "nodes-children")
    values = nodes.select("conv_id", *KEY, (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    height = nodes.agg(F.max("depth")).first()[0] or 0
    totals = _rolled_up(values, places.select("conv_id", *KEY), band, height)
    ends = places.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last")).select("conv_id", "last.*")
    whole = nodes.join(totals.select(*KEY, "n_leaves", F.col("saved").alias("saved_tokens")), list(KEY)).join(_digests(ends), list(KEY), "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
