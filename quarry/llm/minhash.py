"""MinHash near-duplicates with sequential Bayesian verification.

1. Every whole text becomes a set of word shingles (64-bit hashes, sorted) with
   a signature of ``bands * rows`` minima and a 128-bit key of the set.
   Documents of equal sets form one class; its node is the smallest doc_id.
2. Bands of the signature name buckets. In each bucket every class is first
   paired with the smallest one: a group of copies gives as many pairs as it
   has members.
3. A pair's signatures are compared in batches of ``batch`` minima; it is
   dropped when the posterior probability (uniform prior) that its similarity
   reaches the threshold is below ``miss``. Survivors are verified exactly on
   the full sets, taken from the whole texts.
4. Verified links give components. Buckets whose members are then in several
   components have all pairs between different components compared (step 3),
   in blocks of bounded size, so no banded pair that could join two components
   is left out: first on signatures alone, then, for the members with a
   surviving partner, on their full sets. A task returns the links that join
   components, not all pairs. They are added and the components taken again.

Defined results: null, empty and wordless texts have an empty set, link with
nothing and are their own component. Rows with a null doc_id are not compared
(component null, kept). Rows that share a doc_id are one document for the
links. Other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import coded, ranges, scratch, slices, text_column, words_of
from quarry.llm.graph import components

BLOCK = 500  # classes of one bucket that are compared with as many others in one task


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    percent: int = 80       # link if 100 * intersection >= percent * union
    bands: int = 24
    rows: int = 6           # at 80 %: 0.1 % of the pairs share no band; at 85 %: 0.001 %
    batch: int = 16
    miss: float = 1e-6

    @property
    def size(self) -> int:
        return self.bands * self.rows


_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text one after another, offsets)."""
    flat, off = words_of(texts)
    codes, words = coded(flat)
    of = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))[codes]
    n = np.diff(off)
    short = (n > 0) & (n < width)
    per = np.where(short, 1, np.maximum(n - width + 1, 0))
    ends = np.cumsum(per)
    start = np.repeat(off[:-1], per) + (np.arange(int(per.sum())) - np.repeat(ends - per, per))
    h = np.zeros(len(start), np.uint64)
    pad = np.concatenate([of, np.zeros(width, np.uint64)])
    last = np.repeat(off[1:], per)
    for k in range(width):  # a short text's only shingle has no word beyond its end
        w = pad[start + k]
        if short.any():
            w = np.where(start + k < last, w, np.uint64(k + 1))
        h = _mix(h * _M + w + np.uint64(k))
    cut = np.concatenate([[0], ends]).tolist()
    for a, b in zip(cut[:-1], cut[1:]):
        h[a:b].sort()
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    first[np.array(cut[:-1], np.int64)[per > 0]] = True
    upto = np.concatenate([[0], np.cumsum(first)])
    return h[first], upto[np.array(cut, np.int64)]


def signatures(h: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
    """Minima (len(off) - 1, size) of uint32; rows of empty sets hold zeros."""
    rng = np.random.default_rng(20240607)
    mul = rng.integers(1 << 31, 1 << 32, size, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    out = np.zeros((len(off) - 1, size), np.uint32)
    full = np.flatnonzero(np.diff(off) > 0)
    at = 0
    while at < len(full):  # about 64 k hashes at once stay in the cache
        to = max(at + 1, int(np.searchsorted(off[full], off[full[at]] + 65536)))
        rows = full[at:to]
        part = h[off[rows[0]]:off[rows[-1] + 1]]
        low, high = part.astype(np.uint32), (part >> np.uint64(32)).astype(np.uint32)
        starts = off[rows] - off[rows[0]]
        buffer = np.empty_like(low)
        for k in range(size):
            np.multiply(low, mul[k], out=buffer)
            np.add(buffer, high, out=buffer)
            buffer ^= buffer >> np.uint32(15)
            np.multiply(buffer, np.uint32(0x2C1B3C6D), out=buffer)
            out[rows, k] = np.minimum.reduceat(buffer, starts)
        at = to
    return out


def least_matches(p: Params) -> np.ndarray:
    """For each number n of compared minima (a multiple of the batch, or all): the fewest matches with which
    the posterior Beta(m + 1, n - m + 1) still gives the threshold or more a probability of ``miss``."""
    t, out = p.percent / 100, np.zeros(p.size + 1, np.int64)
    for n in [*range(p.batch, p.size, p.batch), p.size]:
        tail, m = 0.0, 0
        for m in range(n + 1):  # P(similarity >= t) = P(Binomial(n + 1, t) <= m)
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= p.miss:
                break
        out[n] = m
    return out


def survivors(a: np.ndarray, b: np.ndarray, p: Params, least: np.ndarray) -> np.ndarray:
    """Which rows of two signature matrices pass the sequential test."""
    alive, match = np.arange(len(a)), np.zeros(len(a), np.int64)
    for at in range(0, p.size, p.batch):
        to = min(at + p.batch, p.size)
        match = match + (a[alive, at:to] == b[alive, at:to]).sum(1)
        ok = match >= least[to]
        alive, match = alive[ok], match[ok]
    return alive


def signed(docs: DataFrame, p: Params, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, key, sig, buckets)`` per row; key, sig and buckets are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            h, off = shingle_sets(text_column(b, text_col), p.shingle)
            n, raw = np.diff(off), h.tobytes()
            sig = signatures(h, off, p.size)
            cut = (off * 8).tolist()
            key = [xxhash.xxh3_128_digest(raw[x:y]) if y > x else None for x, y in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([
                b.column(id_col), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                pa.array([s.tobytes() if k else None for s, k in zip(sig, key)], pa.binary())], names=["doc_id", "n_shingles", "key", "sig"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("key", T.BinaryType()), T.StructField("sig", T.BinaryType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _sig_rows(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, size)


def _pruned(pairs: DataFrame, sigs: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b) whose signatures pass the sequential test."""
    least, kind = least_matches(p), pairs.schema["a"].dataType
    both = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "sig_a", "sig_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = pa.array(survivors(_sig_rows(b.column("sig_a"), p.size), _sig_rows(b.column("sig_b"), p.size), p, least))
            yield b.select(["a", "b"]).take(ok)

    return both.mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)])).distinct()


def _texts(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """``(node, text)`` of the given nodes, written to ``path``."""
    spark = docs.sparkSession
    nodes.write.parquet(f"{path}/nodes")
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).where("node is not null")
    texts.join(spark.read.parquet(f"{path}/nodes"), "node", "left_semi").write.parquet(f"{path}/texts")
    return spark.read.parquet(f"{path}/texts")


def _verified(pairs: DataFrame, docs: DataFrame, p: Params, id_col: str, text_col: str, path: str) -> DataFrame:
    """Pairs whose full sets reach the threshold. A text that stands in several pairs of a batch is cut into words once.

    Pairs and the texts that take part are written to ``path`` first: Spark then knows their size when it plans the joins,
    and only those texts are joined twice.
    """
    kind, spark = pairs.schema["a"].dataType, pairs.sparkSession
    pairs.write.parquet(f"{path}/pairs")
    pairs = spark.read.parquet(f"{path}/pairs")
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), id_col, text_col, path)
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices([whole], "text_a"):
                for c in slices([b], "text_b"):
                    own = pa.concat_arrays([text_column(c, "text_a"), text_column(c, "text_b")]).dictionary_encode()
                    h, off = shingle_sets(own.dictionary, p.shingle)
                    at, n = own.indices.to_numpy(), c.num_rows
                    ok = []
                    for i, (x, y) in enumerate(zip(at[:n].tolist(), at[n:].tolist())):
                        s, t = h[off[x]:off[x + 1]], h[off[y]:off[y + 1]]
                        if not len(s) or not len(t):
                            continue
                        if len(s) > len(t):
                            s, t = t, s
                        if 100 * len(s) < p.percent * len(t):
                            continue
                        inter = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum()) if x != y else len(s)
                        if 100 * inter >= p.percent * (len(s) + len(t) - inter):
                            ok.append(i)
                    yield c.select(["a", "b"]).take(pa.array(ok, pa.int64()))

    return both.mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)])).distinct()


def _blocked(members: DataFrame) -> DataFrame:
    """A bucket of ``blocks`` blocks as pairs (i, j) of blocks: a group holds the members of two blocks at most."""
    m = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return m.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")


class _Group:
    """The members of two blocks of a bucket, and for each left one its right partners that pass the sequential test."""

    def __init__(self, t: pa.Table, p: Params):
        self.p, self.sig = p, _sig_rows(t["sig"], p.size)
        self.component = t["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        self.node = t["node"].combine_chunks()
        self.band = t["band"][0].as_py()
        own, self.i, self.j = t["own"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
        self.left, self.right = np.flatnonzero(own == self.i), np.flatnonzero(own == self.j)

    def pairs(self, least: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Pairs of different components; one that shares an earlier band is left to that band's bucket."""
        p = self.p
        for x in self.left.tolist():
            y = self.right[self.component[self.right] != self.component[x]]
            y = y[y > x] if self.i == self.j else y
            if not len(y):
                continue
            y = y[survivors(np.broadcast_to(self.sig[x], (len(y), p.size)), self.sig[y], p, least)]
            if len(y) and self.band:
                upto = self.band * p.rows
                same = (self.sig[y, :upto] == self.sig[x, :upto]).reshape(len(y), self.band, p.rows).all(2).any(1)
                y = y[~same]
            if len(y):
                yield x, y


def _suspects(members: DataFrame, p: Params) -> DataFrame:
    """``(bucket, node)`` of the members that have a partner in another component which passes the sequential test."""
    least, kind = least_matches(p), members.schema["node"].dataType

    def run(t: pa.Table) -> pa.Table:
        g = _Group(t, p)
        found = np.zeros(t.num_rows, bool)
        for x, y in g.pairs(least):
            found[x] = True
            found[y] = True
        at = pa.array(np.flatnonzero(found))
        return pa.table({"bucket": t["bucket"].take(at), "node": g.node.take(at)})

    out = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("node", kind)])
    return _blocked(members).groupBy("bucket", "i", "j").applyInArrow(run, out).distinct()


def _across(members: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) between different components of a bucket: the pairs that pass the sequential test, verified on their full sets.

    ``members`` also have their text. A group returns as many links as join its components, not all of them.
    """
    least, kind = least_matches(p), members.schema["node"].dataType

    def run(t: pa.Table) -> pa.Table:
        g = _Group(t, p)
        h, off = shingle_sets(text_column(t.combine_chunks().to_batches()[0], "text"), p.shingle)
        size = np.diff(off)
        _, code = np.unique(h, return_inverse=True)
        mark = np.zeros(int(code.max(initial=0)) + 1, np.int64)
        up = list(range(t.num_rows + int(g.component.max()) + 1))
        base = t.num_rows

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for row, c in enumerate(g.component.tolist()):
            up[row] = base + c
        xs, ys = [], []
        for x, y in g.pairs(least):
            y = y[(100 * np.minimum(size[y], size[x]) >= p.percent * np.maximum(size[y], size[x])) & (size[y] > 0)]
            if not len(y) or not size[x]:
                continue
            mark[code[off[x]:off[x + 1]]] = 1
            at = np.cumsum(size[y]) - size[y]
            inter = np.add.reduceat(mark[code[ranges(off[y], size[y])]], at)
            mark[code[off[x]:off[x + 1]]] = 0
            for z in y[100 * inter >= p.percent * (size[x] + size[y] - inter)].tolist():
                a, b = root(x), root(z)
                if a != b:
                    up[a] = b
                    xs.append(x)
                    ys.append(z)
        return pa.table({"a": g.node.take(pa.array(xs, pa.int64())), "b": g.node.take(pa.array(ys, pa.int64()))})

    out = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return (_blocked(members).groupBy("bucket", "i", "j").applyInArrow(run, out)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``."""
    spark = docs.sparkSession
    path = scratch(spark, "minhash")
    signed(docs, p, id_col, text_col).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    # one node per class of equal sets
    full = rows.where("key is not null and doc_id is not null")
    full.groupBy("key", "sig").agg(F.min("doc_id").alias("node")).write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    sigs = classes.select("node", "sig")
    width = 4 * p.rows
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)) for k in range(p.bands)])
    buckets = classes.select("node", F.posexplode(bands).alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("members")).where("members > 1")
    buckets.join(shared, "bucket").write.parquet(f"{path}/buckets")
    placed = spark.read.parquet(f"{path}/buckets")
    stars = placed.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    _verified(_pruned(stars, sigs, p), docs, p, id_col, text_col, f"{path}/first").write.parquet(f"{path}/links1")
    # rows that share a doc_id are one document: every class of that id is its node's
    same = full.select("key", "doc_id").distinct().join(classes.select("key", "node"), "key").where("doc_id <> node") \
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    links = spark.read.parquet(f"{path}/links1")
    named = components(links)
    joined = placed.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = joined.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    columns = ["bucket", "band", "node", "component", "sig"]
    members = joined.join(mixed, "bucket").join(sigs, "node")
    _suspects(members.select(*columns, F.expr(f"(members - 1) div {BLOCK} + 1").alias("blocks")), p).write.parquet(f"{path}/suspects")
    suspects = spark.read.parquet(f"{path}/suspects")
    texts = _texts(docs, suspects.select("node").distinct(), id_col, text_col, f"{path}/second")
    some = suspects.groupBy("bucket").agg(F.expr(f"(count(*) - 1) div {BLOCK} + 1").alias("blocks"))
    kept = joined.join(suspects, ["bucket", "node"]).join(some, "bucket").join(sigs, "node").join(texts, "node")
    _across(kept.select(*columns, "blocks", "text"), p).write.parquet(f"{path}/links2")
    every = components(links.unionAll(spark.read.parquet(f"{path}/links2")).unionAll(same))
    return (rows.select("doc_id", "n_shingles")
            .join(every.select(F.col("node").alias("doc_id"), F.col("component").alias("linked")), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("linked", "doc_id").alias("component_id"),
                    F.coalesce(F.coalesce("linked", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept")))
