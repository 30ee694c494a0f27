"""Embedding near-duplicates by sorted projection passes.

1. Vectors with equal numbers form one class (its node is the smallest vec_id).
2. In a pass the classes are ordered by the bits of 62 random projections (seeded
   by the pass), one after another, and by node. The order is cut into blocks of
   ``block`` classes that also get the last ``window`` ones of the block before.
   A class is compared with its ``window`` neighbours on either side, in double
   precision; a block returns a spanning forest of the pairs it verified, so a
   dense group gives as many pairs as it has members.
3. A class has met all that share its first ``depth`` bits, where depth is one more
   than it shares with the last neighbour on either side. Vectors at the threshold
   agree in a bit with p = 1 - arccos(threshold) / pi, so a link of the class is
   missed by all its passes with a probability of at most prod(1 - p ** depth). Passes go on,
   ``passes`` at first, with the classes for which that is above ``miss``; a link is
   covered if one of its ends is. Once it costs less than the passes still needed
   (many vectors in one direction), the classes left are compared with each other.
4. The pairs found give components. A link never leaves its component,
   so links are counted there: all classes of a component are compared, in
   pairs of blocks, and only counts leave a task.

Equal projections can't make a large block: ties are ordered by node and the
blocks are cut by rank.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite numbers, link with nothing; vectors of different length don't link;
rows with a null vec_id are returned unlinked (component null, kept); rows that
share a vec_id are vectors of their own that count as one node; other columns
are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import scratch
from quarry.llm.graph import components

BITS = 62


def planes(seed: int, dims: int) -> np.ndarray:
    return np.random.default_rng([977, seed, dims]).standard_normal((dims, BITS))


def unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def keyed(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(node, key, dims, raw)``: raw holds the doubles; key and raw are null where a vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, raws, dims = [], [], []
            for v in b.column("v").to_pylist():
                x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.empty(0)
                peak = np.abs(x).max(initial=0)
                ok = len(x) > 0 and np.isfinite(peak) and peak > 0
                x = x / peak if ok else x  # neither squares nor their sum can overflow or vanish
                raws.append((x + 0.0).tobytes() if ok else None)
                keys.append(xxhash.xxh3_128_digest(raws[-1]) if ok else None)
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())],
                                             names=["node", "key", "dims", "raw"])

    schema = T.StructType([T.StructField("node", df.schema[id_col].dataType), T.StructField("key", T.BinaryType()),
                           T.StructField("dims", T.IntegerType()), T.StructField("raw", T.BinaryType())])
    return df.select(F.col(id_col).alias("node"), F.col(vec_col).alias("v")).mapInArrow(run, schema)


def _projected(classes: DataFrame, passes: range) -> DataFrame:
    """One row per pass and class: (pass, dims, bits, node, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                dims, raw = b.column("dims").to_numpy(), b.column("raw").to_pylist()
                for d in np.unique(dims).tolist():
                    rows = np.flatnonzero(dims == d)
                    x = unit([raw[i] for i in rows])
                    own = b.take(pa.array(rows))
                    for p in passes:
                        bits = ((x @ planes(p, d)) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), own.column("dims"), pa.array(bits, pa.int64()),
                                                          own.column("node"), own.column("raw")], names=["pass", "dims", "bits", "node", "raw"])

    schema = T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("dims", T.IntegerType()), T.StructField("bits", T.LongType()),
                           classes.schema["node"], T.StructField("raw", T.BinaryType())])
    return classes.select("node", "dims", "raw").mapInArrow(run, schema)


def _ranked(rows: DataFrame, path: str) -> DataFrame:
    """Rows in their order with ``rank``: partitions are ordered, and the driver adds one number for each."""
    spark = rows.sparkSession
    order = ["pass", "dims", "bits", "node"]
    schema = T.StructType([*rows.schema.fields, T.StructField("slot", T.IntegerType()), T.StructField("nth", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, slot, np.int32)), pa.array(n + np.arange(b.num_rows))],
                                             names=[*b.schema.names, "slot", "nth"])
            n += b.num_rows

    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema).write.parquet(path)
    placed = spark.read.parquet(path)
    sizes = sorted((r.slot, r.n) for r in placed.groupBy("slot").agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for slot, n in sizes:
        before.append((slot, total))
        total += n
    shift = spark.createDataFrame(before, "slot int, before long")  # a row per partition
    return placed.join(F.broadcast(shift), "slot").withColumn("rank", F.col("before") + F.col("nth"))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Indices of pairs (a, b) that join what wasn't yet joined."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append(k)
    return out


def _depth(x: np.ndarray) -> np.ndarray:
    """One more than the leading bits, of ``BITS``, in which two orders agree; x: their exclusive or."""
    high, low = x >> 31, x & ((1 << 31) - 1)
    return BITS + 1 - np.where(high > 0, 31 + np.frexp(high.astype(float))[1], np.frexp(low.astype(float))[1])


def _windowed(classes: DataFrame, path: str, threshold: float, passes: range, window: int, block: int) -> DataFrame:
    """Rows (a, b) of a spanning forest of the verified pairs of every block, and rows (a, pass, depth) of what bounds a class's window."""
    kind = classes.schema["node"].dataType
    ranked = _ranked(_projected(classes, passes), path)
    own = (F.col("rank") / block).cast("long")
    homes = F.when(F.col("rank") % block >= block - window, F.array(own, own + 1)).otherwise(F.array(own))
    placed = ranked.select("pass", "dims", "bits", "node", "raw", "rank", F.explode(homes).alias("block"))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("rank")
        rank, block_no, bits = t["rank"].to_numpy(), t["block"][0].as_py(), t["bits"].to_numpy()
        sort = t["pass"].to_numpy().astype(np.int64) * (1 << 32) + t["dims"].to_numpy()
        raw, node = t["raw"].to_pylist(), t["node"].combine_chunks()
        xs, ys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        ends, depths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s in np.unique(sort):  # only vectors of one pass and length are compared
            rows = np.flatnonzero(sort == s)
            x = unit([raw[i] for i in rows])
            for at in range(0, len(rows), window):
                near = x[at:at + window] @ x[at:at + 2 * window].T
                i, j = np.nonzero(near >= threshold)
                keep = (j > i) & (j - i <= window) & (rank[rows[at + j]] >= block_no * block)  # pairs of the block before are its own
                xs.append(rows[at + i[keep]])
                ys.append(rows[at + j[keep]])
            first, last = rows[:-window], rows[window:]  # the last neighbours that are compared
            here = rank[last] >= block_no * block
            depth = _depth(bits[first[here]] ^ bits[last[here]])
            ends += [first[here], last[here]]
            depths += [depth, depth]
        a, b = np.concatenate(xs), np.concatenate(ys)
        ok = _forest(a, b, len(rank))
        end, depth = np.concatenate(ends), np.concatenate(depths)
        found = pa.table({"a": node.take(pa.array(a[ok], pa.int64())), "b": node.take(pa.array(b[ok], pa.int64())),
                          "pass": pa.nulls(len(ok), pa.int32()), "depth": pa.nulls(len(ok), pa.int32())})
        bound = pa.table({"a": node.take(pa.array(end)), "b": pa.nulls(len(end), node.type),
                          "pass": pa.array(t["pass"].to_numpy()[end], pa.int32()), "depth": pa.array(depth, pa.int32())})
        return pa.concat_tables([found, bound])

    return placed.groupBy("block").applyInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind),
                                                                   T.StructField("pass", T.IntegerType()), T.StructField("depth", T.IntegerType())]))


def _compared(classes: DataFrame, count: int, threshold: float, size: int, step: int) -> DataFrame:
    """(a, b) of a spanning forest of the verified pairs of every two blocks of about ``size`` classes: all are compared."""
    kind = classes.schema["node"].dataType
    blocks = (count - 1) // size + 1
    m = classes.select("node", "dims", "raw", F.pmod(F.xxhash64("raw"), F.lit(blocks)).alias("own"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    m = m.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def run(t: pa.Table) -> pa.Table:
        own, i, j = t["own"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
        raw, dims, node = t["raw"].to_pylist(), t["dims"].to_numpy(), t["node"].combine_chunks()
        up, xs, ys = len(own), [], []
        for d in np.unique(dims):
            left, right = np.flatnonzero((own == i) & (dims == d)), np.flatnonzero((own == j) & (dims == d))
            if not len(left) or not len(right):
                continue
            x, y = unit([raw[k] for k in left]), unit([raw[k] for k in right])
            for at in range(0, len(left), step):
                k, n = np.nonzero(x[at:at + step] @ y.T >= threshold)
                a, b = left[at + k], right[n]
                ok = _forest(a, b, up)  # at most a pair for each class, also where a step has many
                xs.append(a[ok])
                ys.append(b[ok])
        a, b = np.concatenate([np.empty(0, np.int64), *xs]), np.concatenate([np.empty(0, np.int64), *ys])
        ok = _forest(a, b, up)
        return pa.table({"a": node.take(pa.array(a[ok], pa.int64())), "b": node.take(pa.array(b[ok], pa.int64()))})

    return m.drop("other").groupBy("i", "j").applyInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def verified_pairs(classes: DataFrame, path: str, threshold: float, passes: int, window: int, block: int, miss: float) -> DataFrame:
    """Distinct (a, b) that join all classes with a cosine of ``threshold``, each link but for a probability of ``miss``."""
    spark, goal = classes.sparkSession, -float(np.log(miss))
    agree = 1 - float(np.arccos(min(threshold, 1.0))) / np.pi
    met = F.when(F.col("depth") > BITS, 0.0).otherwise(F.pow(F.lit(agree), F.col("depth")))
    left, now, pairs = classes.select("node", "dims", "raw", F.lit(0.0).alias("sure")), range(passes), None
    while True:
        at = f"{path}/passes-{now.start}"
        _windowed(left, f"{at}/ranked", threshold, now, window, block).write.parquet(f"{at}/found")
        found = spark.read.parquet(f"{at}/found")
        joined = found.where("depth is null").select("a", "b")
        pairs = joined if pairs is None else pairs.unionAll(joined)
        # a class without a bound in some pass has met all others there
        gain = (found.where("depth is not null").groupBy("a", "pass").agg(F.max("depth").alias("depth"))
                .groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n"), F.sum(-F.log1p(-F.least(met, F.lit(1 - 1e-12)))).alias("gain"))
                .where(F.col("n") == len(now)).drop("n"))
        (left.join(gain, "node").withColumn("sure", F.col("sure") + F.col("gain")).where(F.col("sure") < goal)
         .write.parquet(f"{at}/left"))
        left = spark.read.parquet(f"{at}/left")
        n, need = left.agg(F.count("*"), F.avg((goal - F.col("sure")) / F.greatest(F.col("gain") / len(now), F.lit(1e-9)))).first()
        if not n:
            break
        if n <= (2 * window + 1024) * need:  # comparisons of a class: with all, or of a pass (its row costs like 1,024)
            pairs = pairs.unionAll(_compared(left, n, threshold, block, window))
            break
        now = range(now.stop, now.stop + min(passes, int(np.ceil(need))))
        left = left.drop("gain")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _degrees(members: DataFrame, threshold: float, size: int) -> DataFrame:
    """``(key, links)`` of the classes of each component: members of all other classes with a cosine of ``threshold`` or more.

    ``members``: (component, blocks, key, dims, raw, copies).
    """
    m = members.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    m = m.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def run(t: pa.Table) -> pa.Table:
        own, i, j = t["own"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
        raw, copies, dims = t["raw"].to_pylist(), t["copies"].to_numpy(), t["dims"].to_numpy()
        links = np.zeros(len(own), np.int64)
        for d in np.unique(dims):
            left, right = np.flatnonzero((own == i) & (dims == d)), np.flatnonzero((own == j) & (dims == d))
            if not len(left) or not len(right):
                continue
            x, y = unit([raw[k] for k in left]), unit([raw[k] for k in right])
            for at in range(0, len(left), size):
                near = x[at:at + size] @ y.T >= threshold
                rows = left[at:at + size]
                if i == j:
                    near[np.arange(len(rows)), at + np.arange(len(rows))] = False
                else:
                    links[right] += copies[rows] @ near
                links[rows] += near @ copies[right]
        return pa.table({"key": t["key"], "links": links})

    return (m.drop("other").groupBy("component", "i", "j").applyInArrow(run, "key binary, links long")
            .groupBy("key").agg(F.sum("links").alias("links")))


def near_duplicates(df: DataFrame, threshold: float = 0.9, passes: int = 8, window: int = 256, block: int = 4096, miss: float = 1e-3,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row."""
    spark = df.sparkSession
    path = scratch(spark, "embedding-dedup")
    keyed(df, id_col, vec_col).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    full = rows.where("key is not null and node is not null")
    full.groupBy("key", "dims", "raw").agg(F.min("node").alias("node"), F.count("*").alias("copies")).write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    pairs = verified_pairs(classes, path, threshold, passes, window, block, miss)
    same = full.select("key", F.col("node").alias("a")).distinct().join(classes.select("key", F.col("node").alias("b")), "key").where("a <> b").select("a", "b")
    named = components(pairs.unionAll(same))
    members = classes.join(named, "node")
    blocks = members.groupBy("component").agg(F.expr("(count(*) - 1) div 1024 + 1").alias("blocks"), F.count("*").alias("n")).where("n > 1")
    degree = _degrees(members.join(blocks, "component").select("component", "blocks", "key", "dims", "raw", "copies"), threshold, 512)
    per_key = classes.select("key", "copies").join(degree, "key", "left").select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return (rows.select("node", "key").join(per_key, "key", "left").join(named, "node", "left")
            .select(F.col("node").alias(id_col), F.when(F.col("node").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), F.coalesce("component", "node").alias("component_id"),
                    F.coalesce(F.coalesce("component", "node") == F.col("node"), F.lit(True)).alias("kept")))
