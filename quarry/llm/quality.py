"""Quality scores by a factorisation machine.

Features of a whole text: its hashed words (damped counts, normalised),
statistics of its structure and its length. Besides a weight, each feature has
a vector of ``RANK`` numbers; every pair of features adds the product of their
vectors. With the identity sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 -
sum |v_i|^2 x_i^2) / 2 a text is scored in time linear in its features.

The machine is fitted (Adam, log loss) on about ``SAMPLE`` labelled rows, chosen
by a hash of the id; with that bound, only their features reach the driver.

Defined results: a null or empty text is scored by its statistics alone; rows
without a label, or with one that is neither 0 nor 1, are not learned from; a
doc_id labelled twice is learned from twice; without labels every score is
0.5; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import buffers_of, coded, free, slices, text_column, unclaimed, words_of

SAMPLE = 8000        # labelled rows, about, that the machine is fitted on
SAMPLE_BYTES = 128 << 20  # of their texts: the features of a sample pass through the driver
BUCKETS = 1 << 15    # hashed words
RANK = 6
EPOCHS = 12
STEP = 4 << 20

STATS = ["bias", "log_words", "log_bytes", "letters", "upper", "digits", "marks", "spaces", "non_ascii", "word_bytes",
         "distinct_words", "line_words", "repeated_lines", "sentence_marks", "odd_words", "log_lines"]
N_STATS = len(STATS)


@dataclass
class Machine:
    w0: float
    w: np.ndarray      # (BUCKETS + N_STATS,)
    v: np.ndarray      # (BUCKETS + N_STATS, RANK)
    mean: np.ndarray   # of the statistics
    scale: np.ndarray


def _class_table() -> np.ndarray:
    t = np.zeros(256, np.int64)  # 0 control, 1 lower, 2 upper, 3 digit, 4 mark, 5 space, 6 non-ASCII, 7 sentence mark
    t[97:123], t[65:91], t[48:58], t[128:] = 1, 2, 3, 6
    t[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
    t[[32, *range(9, 14)]] = 5
    t[[ord(c) for c in ".,;:?!"]] = 7
    return t


_CLASS = _class_table()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row offsets, hashed word of each entry, its value, statistics (rows, N_STATS))."""
    rows = len(texts)
    data, off = buffers_of(texts)
    size = np.diff(off)
    row = np.repeat(np.arange(rows, dtype=np.int64), size)
    kinds = np.bincount(row * 8 + _CLASS[data], minlength=rows * 8).reshape(rows, 8).astype(float)
    flat, cut = words_of(texts)
    codes, words = coded(flat)
    n_words = np.diff(cut)
    raw = words.cast(pa.large_binary()).to_pylist()
    bucket = np.fromiter((xxhash.xxh32_intdigest(w) for w in raw), np.int64, len(raw)) % BUCKETS
    plain = np.fromiter((w.strip(b".,;:?!\"'()").isalpha() or not w.isascii() for w in raw), bool, len(raw))
    of = np.repeat(np.arange(rows, dtype=np.int64), n_words)
    key, count = np.unique(of * BUCKETS + bucket[codes], return_counts=True) if len(codes) else (np.empty(0, np.int64),) * 2
    r, b = key // BUCKETS, key % BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(r, value**2, minlength=rows))
    value = value / np.maximum(norm[r], 1e-12)
    upto = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=rows))])
    lines = [[x for x in t.split("\n") if x.strip()] for t in texts.to_pylist()]
    n_lines = np.array([len(x) for x in lines], float)
    again = np.array([len(x) - len(set(x)) for x in lines], float)
    odd = np.bincount(of, (~plain)[codes], minlength=rows) if len(codes) else np.zeros(rows)
    pair = np.unique(of * (len(words) + 1) + codes) if len(codes) else np.empty(0, np.int64)
    distinct = np.bincount(pair // (len(words) + 1), minlength=rows)
    b1, w1, l1 = np.maximum(size, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
    stats = np.column_stack([
        np.ones(rows), np.log1p(n_words), np.log1p(size), (kinds[:, 1] + kinds[:, 2]) / b1, kinds[:, 2] / b1, kinds[:, 3] / b1,
        kinds[:, 4] / b1, kinds[:, 5] / b1, kinds[:, 6] / b1, np.log1p((size - kinds[:, 5]) / w1), distinct / w1,
        np.log1p(n_words / l1), again / l1, kinds[:, 7] / w1, odd / w1, np.log1p(n_lines)])
    return upto, b, value, stats


def _sums(m: Machine, upto, idx, val, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(raw score, sum of v x per row, entries' idx and val with the statistics appended is implied)."""
    x = (stats - m.mean) / m.scale
    x[:, 0] = 1.0
    rows = len(x)
    of = np.repeat(np.arange(rows), np.diff(upto))
    lin = np.bincount(of, m.w[idx] * val, minlength=rows) + x @ m.w[BUCKETS:]
    vx = m.v[idx] * val[:, None]
    s, q = x @ m.v[BUCKETS:], (x**2) @ (m.v[BUCKETS:] ** 2)
    for f in range(m.v.shape[1]):
        s[:, f] += np.bincount(of, vx[:, f], minlength=rows)
        q[:, f] += np.bincount(of, vx[:, f] ** 2, minlength=rows)
    return m.w0 + lin + 0.5 * (s**2 - q).sum(1), s, x, of


def probability(m: Machine, upto, idx, val, stats) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_sums(m, upto, idx, val, stats)[0], -30, 30)))


def train(upto, idx, val, stats, y, epochs: int = EPOCHS, seed: int = 5) -> Machine:
    """Adam on the log loss, all parameters at once; the classes weigh alike as they stand."""
    rng = np.random.default_rng(seed)
    n = BUCKETS + N_STATS
    scale = np.maximum(stats.std(0), 1e-6)
    m = Machine(0.0, np.zeros(n), rng.normal(0, 0.02, (n, RANK)), stats.mean(0), scale)
    m.w0 = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    mom = [np.zeros((n, RANK + 1)), np.zeros((n, RANK + 1))]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 256):
            pick = order[at:at + 256]
            take = np.concatenate([np.arange(upto[i], upto[i + 1]) for i in pick])
            cut = np.concatenate([[0], np.cumsum(upto[pick + 1] - upto[pick])])
            i, xv = idx[take], val[take]
            raw, s, x, of = _sums(m, cut, i, xv, stats[pick])
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[pick]) / len(pick)
            used, back = np.unique(i, return_inverse=True)
            grad = np.zeros((len(used) + N_STATS, RANK + 1))
            gx = g[of] * xv
            grad[:len(used), 0] = np.bincount(back, gx, minlength=len(used))
            for f in range(RANK):
                grad[:len(used), f + 1] = np.bincount(back, gx * (s[of, f] - m.v[i, f] * xv), minlength=len(used))
            grad[len(used):, 0] = g @ x
            grad[len(used):, 1:] = (g[:, None] * x).T @ s - m.v[BUCKETS:] * ((g[:, None] * x**2).sum(0))[:, None]
            where = np.concatenate([used, np.arange(BUCKETS, n)])
            grad[:, 0] += 1e-5 * m.w[where]
            grad[:, 1:] += 1e-5 * m.v[where]
            t += 1
            mom[0][where] = 0.9 * mom[0][where] + 0.1 * grad
            mom[1][where] = 0.99 * mom[1][where] + 0.01 * grad**2
            step = 0.02 * (mom[0][where] / (1 - 0.9**t)) / (np.sqrt(mom[1][where] / (1 - 0.99**t)) + 1e-8)
            m.w[where] -= step[:, 0]
            m.v[where] -= step[:, 1:]
    return m


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> Machine | None:
    """Fit on the given documents and labels (the caller leaves out what is held out); None without labels."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    # equal rows say the same thing once, so neither an id nor a text with very many rows enters the sample as a whole
    key = F.xxhash64(F.col(id_col), F.col(text_col)).alias("key")
    places = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), key, F.octet_length(text_col).alias("size"))
    marked = marked.join(places, "id").distinct()
    total = marked.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    share = min(1.0, sample / max(total["n"], 1), SAMPLE_BYTES / max(total["bytes"] or 0, 1))
    chosen = marked.where(F.pmod(F.xxhash64("key", "y", F.lit(11)), F.lit(1 << 40)) < F.lit(share * (1 << 40))).select("id", "key", "y")
    texts = docs.select(F.col(id_col).alias("id"), key, F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), ["id", "key"]).dropDuplicates(["id", "key", "y"]).select("y", "text")  # about SAMPLE rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", STEP):
            upto, idx, val, stats = features(text_column(b, "text"))
            parts = []
            for i in range(b.num_rows):
                own, v = idx[upto[i]:upto[i + 1]], val[upto[i]:upto[i + 1]]
                parts.append((own.astype(np.int32).tobytes(), v.astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary()),
                                              pa.array([s.tobytes() for s in stats], pa.binary())], names=["y", "i", "v", "s"])

    got = sorted(rows.mapInArrow(run, "y int, i binary, v binary, s binary").collect(), key=lambda r: (bytes(r.s), bytes(r.i), r.y))
    if not got:
        return None
    idx = [np.frombuffer(r.i, np.int32) for r in got]
    upto = np.concatenate([[0], np.cumsum([len(x) for x in idx])])
    return train(upto, np.concatenate(idx).astype(np.int64), np.concatenate([np.frombuffer(r.v, np.float32) for r in got]).astype(float),
                 np.array([np.frombuffer(r.s, np.float64) for r in got]), np.array([r.y for r in got], float))


def score(docs: DataFrame, machine: Machine | None, keep: list, text_col: str = "text", result: str = "score") -> DataFrame:
    """``(*keep, result double)``: the probability of label 1 for every whole text; a kept column called ``result`` is an error."""
    names = docs.select(*keep).columns
    unclaimed(names, result)
    own = free(names, "text")
    frame = docs.select(*keep, F.col(text_col).alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, own, STEP):
            p = probability(machine, *features(text_column(b, own))) if machine else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(p, pa.float64())], names=[*names, result])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields[:-1], T.StructField(result, T.DoubleType())]))
