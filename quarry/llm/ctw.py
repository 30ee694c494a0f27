"""Language-model scores by context-tree weighting over bytes.

A text is coded as its bytes and an end symbol (0xFF, which UTF-8 doesn't use).
Each symbol is taken apart into 8 binary decisions. A decision in the context
of the last d bytes (d = 0..DEPTH) has a node with the counts of 0 and 1 in the
training texts, and the Krichevsky-Trofimov estimate of them. Bottom-up, a
node's weighted probability is the mean of its own estimate and the product of
its children's (the contexts one byte longer); the resulting weights mix the
estimates of all depths when a text is scored with the frozen counts.

Training: each task sorts the (DEPTH + 1)-grams of its texts and emits every
distinct one with its count, so what is shuffled follows the corpus. Counts of
shorter contexts are sums of these. The grams, most recent byte first, are dealt
by ranges of the two most recent bytes; each range builds its own subtrees as
sorted arrays, one row (chunk) for some hundred thousand grams, in the shared
folder, with the finished probability of every gram that the training texts hold. Only the at most 65,535 nodes of depths 0 and 1 pass through the driver.

Scoring: a task looks up each distinct gram of a block of texts once. It holds the model if that has at most RESIDENT nodes, and otherwise reads
it chunk by chunk for each block: memory is bounded and the result the same.

The unigram base needs the corpus count of every word: each block contributes
each of its distinct words once, so the most common word gives one row a block.

Defined results: a null text is empty and is scored as its end alone; repeated
rows count as often as they stand there; a null id belongs to the training
rows; without training rows every binary decision has probability 1/2 and the
base is 0; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from quarry.llm.blocks import SPACED, buffers_of, coded, gathered, scratch, slices, text_column, words_of
from quarry.llm.langid import held_out

DEPTH = 5               # bytes of context
END = 0xFF
CHUNK_GRAMS = 200_000   # grams per chunk of the model, and up to the end of a range of contexts
RESIDENT = 6_000_000    # nodes (16 bytes each) that a worker keeps
TRAIN_BYTES = 4 << 20   # text counted at once
SCORE_BYTES = 7 << 20   # text of a block
_8 = np.uint64(8)
_FF = np.uint64(255)


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5: eight steps up, then Stirling's series."""
    s, y = np.zeros(len(x)), np.asarray(x, float).copy()
    for _ in range(8):
        s += np.log(y)
        y += 1
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - s


def symbols(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with ``depth`` end symbols before each text and one behind it, which of them are coded, symbols of each text)."""
    data, off = buffers_of(texts)
    size = np.diff(off) + 1
    edge = np.zeros(int(size.sum()) + depth * len(size) + 1, np.int8)
    ends = np.cumsum(size + depth)
    edge[ends - size - depth] += 1
    edge[ends - size] -= 1  # the symbols in front of a text aren't coded
    coded_ = np.cumsum(edge[:-1], dtype=np.int8) == 0
    padded = np.full(len(coded_), END, np.uint8)
    text = coded_.copy()
    text[ends - 1] = False
    padded[text] = data
    return padded, coded_, size


def keys_of(padded: np.ndarray, coded_: np.ndarray, depth: int, bits: int = 8) -> np.ndarray:
    """One key per symbol: the ``depth`` symbols before it, the nearest first, and the symbol itself, ``bits`` each."""
    n, b = len(padded) - depth, np.uint64(bits)
    if n <= 0:
        return np.empty(0, np.uint64)
    key = padded[depth - 1:depth - 1 + n].astype(np.uint64)
    for i in range(2, depth + 1):
        key <<= b
        key |= padded[depth - i:depth - i + n]
    key <<= b
    key |= padded[depth:]
    return key[coded_[depth:]]


def runs(key: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = runs(key)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def bit_nodes(ctx: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, zeros, ones), sorted: a node is its context and the bits so far behind a leading 1. ``ctx``: sorted (context, symbol)."""
    ids, zeros, ones = [], [], []
    for level in range(8):
        node, bit = node_at(ctx, level)
        at = runs(node)
        ids.append(node[at])
        ones.append(np.add.reduceat(n * bit, at))
        zeros.append(np.add.reduceat(n * (1 - bit), at))
    ids, zeros, ones = map(np.concatenate, (ids, zeros, ones))
    order = np.argsort(ids)
    return ids[order], zeros[order].astype(float), ones[order].astype(float)


def node_at(ctx: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(node of the decision at this level, the bit taken there)."""
    x = ctx & _FF
    prefix = np.uint64(1 << level) | (x >> np.uint64(8 - level))
    return (ctx >> _8 << _8) | prefix, ((x >> np.uint64(7 - level)) & np.uint64(1)).astype(np.int64)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1) - math.log(math.pi)


def weigh(estimate: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, weight of the node's own estimate)."""
    return math.log(0.5) + np.logaddexp(estimate, children), 1 / (1 + np.exp(np.clip(children - estimate, -700, 700)))


def subtree(key: np.ndarray, n: np.ndarray, depth: int) -> tuple[list, tuple]:
    """Nodes (ids, weight, probability of 1) of depths ``depth`` down to 2, and what depth 1 needs of depth 2."""
    out, below = [], None
    for d in range(depth, 1, -1):
        ctx, c = summed((key >> np.uint64(8 * (depth - d) + 8) << _8) | (key & _FF), n)
        ids, zeros, ones = bit_nodes(ctx, c)
        estimate = kt(zeros, ones)
        if below is None:
            weighted, own = estimate, np.ones(len(ids))
        else:
            parent = (below[0] >> np.uint64(16) << _8) | (below[0] & _FF)
            weighted, own = weigh(estimate, np.bincount(np.searchsorted(ids, parent), below[1], minlength=len(ids)))
        below = (ids, weighted)
        out.append((ids, own.astype(np.float32), ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32)))
    return out, (*below, zeros, ones)


def log10_of(key: np.ndarray, depth: int, nodes: list) -> np.ndarray:
    """log10 probability of each (context, symbol); ``nodes``: (ids, weight, probability) of depths ``depth``..0."""
    out = np.zeros(len(key))
    for level in range(8):
        p, bit = np.full(len(key), 0.5), None
        for k, (ids, own, one) in enumerate(nodes):
            node, bit = node_at((key >> np.uint64(8 * k + 8) << _8) | (key & _FF), level)
            if not len(ids):
                continue
            at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
            p = np.where(ids[at] == node, own[at] * one[at].astype(float) + (1 - own[at].astype(float)) * p, 0.5)
        out += np.log10(np.where(bit == 1, p, 1 - p))
    return out


def count_grams(training: DataFrame, text_col: str, depth: int) -> DataFrame:
    """``(key, n)``: every distinct gram of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def merged():
            return summed(np.concatenate(keys), np.concatenate(counts))

        for b in slices(batches, text_col, TRAIN_BYTES):
            padded, coded_, _ = symbols(text_column(b, text_col), depth)
            key = keys_of(padded, coded_, depth)
            key.sort()
            at = runs(key)
            keys.append(key[at])
            counts.append(np.diff(np.append(at, len(key))))
            held += len(at)
            if held > 2_000_000:
                key, n = merged()
                keys, counts, held = [key], [n], 0
                if len(key) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])
                    keys, counts = [], []
        if keys:
            key, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    return training.select(text_col).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, text_col: str = "text", depth: int = DEPTH) -> SimpleNamespace:
    """The model: its chunks in the shared folder and the nodes of depths 1 and 0."""
    spark = training.sparkSession
    path = scratch(spark, "ctw")
    count_grams(training, text_col, depth).write.parquet(f"{path}/grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(8 * (depth - 1))

        def chunk(key, n):
            nodes, two = subtree(key, n, depth)
            names = ["lo", "hi", "size", "keys", "ids", "own", "one", "two"]
            return pa.RecordBatch.from_arrays([
                pa.array([int(key[0] >> shift)]), pa.array([int(key[-1] >> shift)]), pa.array([sum(len(x[0]) for x in nodes)], pa.int64()),
                pa.array([key.tobytes()], pa.binary()),
                *(pa.array([[x[k].tobytes() for x in nodes]], pa.list_(pa.binary())) for k in range(3)),
                pa.array([[x.tobytes() for x in two]], pa.list_(pa.binary()))], names=names)

        key, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        for b in batches:
            key = np.concatenate([key, b.column("key").to_numpy().astype(np.uint64)])
            n = np.concatenate([n, b.column("n").to_numpy()])
            while len(key) > CHUNK_GRAMS:
                cut = int(np.searchsorted(key >> shift, key[CHUNK_GRAMS] >> shift))  # contexts of the same two bytes stay together
                cut = cut or int(np.searchsorted(key >> shift, key[0] >> shift, side="right"))
                if cut == len(key):
                    break
                yield chunk(key[:cut], n[:cut])
                key, n = key[cut:], n[cut:]
        if len(key):
            yield chunk(key, n)

    schema = "lo long, hi long, size long, keys binary, ids array<binary>, own array<binary>, one array<binary>, two array<binary>"
    near = F.shiftright("key", 8 * (depth - 1)).alias("near")
    (spark.read.parquet(f"{path}/grams").select("key", "n", near).repartitionByRange("near").sortWithinPartitions("key").select("key", "n")
     .mapInArrow(run, schema).write.option("compression", "zstd").parquet(f"{path}/nodes"))
    chunks = spark.read.parquet(f"{path}/nodes")
    parts, size = [], 0
    for r in chunks.select("size", "two").toLocalIterator():
        size += r.size
        ids, weighted, zeros, ones = (np.frombuffer(x, t) for x, t in zip(r.two, (np.uint64, float, float, float)))
        parent = (ids >> np.uint64(16) << _8) | (ids & _FF)
        up, back = np.unique(parent, return_inverse=True)  # at most 65,280 in all chunks together, and a few shared ones
        parts.append((up, *(np.bincount(back, x, minlength=len(up)) for x in (weighted, zeros, ones))))
    tops = _top(parts)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                b = whole.slice(i, 1)
                logs = log10_of(np.frombuffer(b.column("keys")[0].as_py(), np.uint64), depth, [*_nodes(b.to_pylist()[0]), *tops])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([logs.astype(np.float32).tobytes()], pa.binary())], names=[*b.schema.names, "logs"])

    columns = "lo long, hi long, size long, keys binary, ids array<binary>, own array<binary>, one array<binary>"
    (chunks.drop("two").mapInArrow(known, columns + ", logs binary").write.option("compression", "none").parquet(f"{path}/model"))
    return SimpleNamespace(depth=depth, folder=f"{path}/model", size=size, top=tops)


def _nodes(row: dict) -> list:
    return [(np.frombuffer(i, np.uint64), np.frombuffer(w, np.float32), np.frombuffer(p, np.float32)) for i, w, p in zip(row["ids"], row["own"], row["one"])]


def _top(parts: list[tuple]) -> list:
    """Depths 1 and 0 from per-chunk sums over the children of depth-1 nodes."""
    if not parts:
        e = np.empty(0)
        return [(e.astype(np.uint64), e, e)] * 2
    ids, children, zeros, ones = (np.concatenate(x) for x in zip(*parts))
    out = []
    for _ in range(2):
        up, back = np.unique(ids, return_inverse=True)
        children, zeros, ones = (np.bincount(back, x, minlength=len(up)) for x in (children, zeros, ones))
        children, own = weigh(kt(zeros, ones), children)
        out.append((up, own.astype(np.float32), ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32)))
        ids = (up >> np.uint64(16) << _8) | (up & _FF)
    return out


def _widened(key: np.ndarray, alphabet: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Keys of 8 bits a symbol; the order stays."""
    out = np.zeros(len(key), np.uint64)
    for i in range(depth, -1, -1):
        out = (out << _8) | alphabet[((key >> np.uint64(bits * i)) & np.uint64((1 << bits) - 1)).astype(np.int64)].astype(np.uint64)
    return out


class Scorer:
    """Looks up grams in the model's chunks, in the order of their ranges."""

    def __init__(self, model: SimpleNamespace):
        self.model, self.kept = model, None
        self.system, base = pafs.FileSystem.from_uri(model.folder)
        self.files = sorted(f.path for f in self.system.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".parquet"))

    def _read(self) -> Iterator[tuple]:
        for f in self.files:
            with self.system.open_input_file(f) as source:
                for b in pq.ParquetFile(source).iter_batches(1, columns=["lo", "hi", "keys", "logs", "ids", "own", "one"]):
                    r = b.to_pylist()[0]
                    yield r["lo"], r["hi"], np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["logs"], np.float32), _nodes(r)

    def chunks(self) -> Iterator[tuple]:
        if self.model.size > RESIDENT:
            return self._read()
        if self.kept is None:
            self.kept = list(self._read())
        return iter(self.kept)

    def log10(self, key: np.ndarray) -> np.ndarray:
        """For sorted distinct grams."""
        depth, shift = self.model.depth, np.uint64(8 * (self.model.depth - 1))
        near = key >> shift
        out, done = np.zeros(len(key)), np.zeros(len(key), bool)
        for lo, hi, keys, logs, nodes in self.chunks():
            a, z = int(np.searchsorted(near, np.uint64(lo))), int(np.searchsorted(near, np.uint64(hi), side="right"))
            if z > a:
                own = key[a:z]
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                seen = keys[at] == own  # grams of the training texts are worked out already
                out[a:z][seen] = logs[at[seen]]
                out[a:z][~seen] = log10_of(own[~seen], depth, [*nodes, *self.model.top])
                done[a:z] = True
        e = (np.empty(0, np.uint64), np.empty(0, np.float32), np.empty(0, np.float32))
        rest = ~done  # contexts that no chunk covers
        out[rest] = log10_of(key[rest], depth, [e] * (depth - 1) + self.model.top)
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability of each text, its symbols)."""
        depth = self.model.depth
        padded, coded_, size = symbols(texts, depth)
        # few different bytes: fewer bits a symbol, so that a gram and its place fit one number and one sort brings equal grams together
        alphabet = np.flatnonzero(np.bincount(padded, minlength=256))
        bits = max(1, int(len(alphabet) - 1).bit_length())
        code = np.zeros(256, np.uint8)
        code[alphabet] = np.arange(len(alphabet))
        key = keys_of(code[padded], coded_, depth, bits)
        del padded, coded_
        room = min(64 - bits * (depth + 1), 22)
        value = np.empty(len(key), np.float32)
        if room >= 20:
            for at in range(0, len(key), 1 << room):
                part = key[at:at + (1 << room)]
                both = (part << np.uint64(room)) | np.arange(len(part), dtype=np.uint64)
                both.sort()
                first = runs(both >> np.uint64(room))
                each = self.log10(_widened(both[first] >> np.uint64(room), alphabet, bits, depth))
                value[at + (both & np.uint64((1 << room) - 1)).astype(np.int64)] = np.repeat(each, np.diff(np.append(first, len(both))))
        else:
            at_, distinct = pd.factorize(key)
            order = np.argsort(distinct)
            each = np.empty(len(distinct))
            each[order] = self.log10(_widened(distinct[order], alphabet, bits, depth))
            value = each[at_]
        return np.add.reduceat(value, np.cumsum(size) - size, dtype=float) if len(size) else np.empty(0), size


def score(docs: DataFrame, model: SimpleNamespace, train_of, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores and unigram base of every whole text. ``train_of``: Column, true for rows whose words count."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    path = scratch(spark, "ctw-score")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), train_of.alias("train"))
    made: list[Scorer] = []

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Scorer(model))
        at = TaskContext.get().partitionId() << 32
        for b in gathered(batches, "text", SCORE_BYTES):
            texts = text_column(b, "text")
            value, size = made[0].texts(texts)
            flat, off = words_of(texts, SPACED)
            codes, terms = coded(flat)
            train = b.column("train").to_numpy(zero_copy_only=False).astype(bool)
            n = np.bincount(codes[np.repeat(train, np.diff(off))], minlength=len(terms))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            raw = lambda x: pa.array([x.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array([at], pa.int64()), one(b.column("doc_id")), one(b.column("train")), raw(np.diff(off).astype(np.int64)), raw(codes.astype(np.int32)),
                one(terms.cast(pa.string())), one(pa.array(n, pa.int64())), raw(value), raw(size.astype(np.int64))],
                names=["block", "ids", "train", "words", "codes", "terms", "n", "value", "symbols"])
            at += 1

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("train", T.ArrayType(T.BooleanType())),
                           T.StructField("words", T.BinaryType()), T.StructField("codes", T.BinaryType()), T.StructField("terms", T.ArrayType(T.StringType())),
                           T.StructField("n", T.ArrayType(T.LongType())), T.StructField("value", T.BinaryType()), T.StructField("symbols", T.BinaryType())])
    rows.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(f"{path}/blocks")
    kept = spark.read.parquet(f"{path}/blocks")
    # corpus count of each word of each block; a word stands once in a block
    said = kept.select("block", F.posexplode(F.arrays_zip("terms", "n")).alias("i", "t")).select("block", "i", F.col("t.terms").alias("term"), F.col("t.n").alias("n"))
    same = Window.partitionBy("term")
    counted = said.select("block", "i", F.sum("n").over(same).alias("c"), (F.min("block").over(same) == F.col("block")).alias("once"))
    counted.write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    seen = counts.where("once").agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = rows.where("train").count()
    n_all, v_all = (seen.n or 0) + ends, (seen.v or 0) + (ends > 0)

    out = T.StructType([T.StructField("doc_id", kind), T.StructField("train", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                        T.StructField("score", T.DoubleType()), T.StructField("n_symbols", T.LongType())])

    def based(left: pa.Table, right: pa.Table) -> pa.Table:
        c = np.zeros(right.num_rows, np.int64)
        c[right["i"].to_numpy()] = right["c"].to_numpy()
        tables = []
        for r in range(left.num_rows):
            own = left.slice(r, 1)
            get = lambda k, t: np.frombuffer(own[k][0].as_py(), t)
            words, codes = get("words", np.int64), get("codes", np.int32)
            count = c[codes]
            upto = np.concatenate([[0], np.cumsum(words)])
            log = np.log10((c + 0.5) / (n_all + 0.5 * (v_all + 1)))[codes] if len(codes) else np.empty(0)
            of = np.repeat(np.arange(len(words)), words)
            base = np.bincount(of, log, minlength=len(words)) + math.log10((ends + 0.5) / (n_all + 0.5 * (v_all + 1)))
            known = np.bincount(of, count > 0, minlength=len(words)).astype(np.int64) + (ends > 0)
            assert upto[-1] == len(codes)
            tables.append(pa.table({"doc_id": own["ids"].combine_chunks().flatten(), "train": own["train"].combine_chunks().flatten(), "n_tokens": words + 1,
                                    "n_known": known, "train_tokens": np.full(len(words), n_all), "base_score": base,
                                    "score": get("value", float), "n_symbols": get("symbols", np.int64)}))
        return pa.concat_tables(tables) if tables else pa.Table.from_pylist([], schema=_arrow(out))

    return (kept.select("block", "ids", "train", "words", "codes", "value", "symbols").groupBy("block")
            .cogroup(counts.select("block", "i", "c").groupBy("block")).applyInArrow(based, out))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, folds: int = 5, fold: int = 1) -> DataFrame:
    """Fit on the documents outside the fold and score all of them."""
    train = ~held_out(id_col, folds, fold)
    return score(docs, fit(docs.where(train), text_col, depth), train, id_col, text_col)
