"""Language identification by nearest centroids.

Every whole text becomes counts of its hashed byte bigrams and trigrams (A-Z
lower-cased; runs of anything but letters and non-ASCII bytes are one space).
Counts are damped (log), weighted by inverse document frequency and normalised.
Each language has several centroids (spherical k-means); a text takes the
language of the centroid with the largest cosine and is rejected when that
cosine is below the centroid's own limit: ``SLACK`` times that of the farthest
of its sample texts, less for texts of few n-grams.

Document frequencies and the number of texts of a language cover all training
rows. The centroids are fitted on a sample of about ``sample`` rows in all,
shared evenly by the languages and chosen by a hash of the row.

Defined results: a text that is null, empty or has no letter is ``und`` with
score 0, and rejected; training rows with a null language are not used; with
no training rows at all every text is ``und``; repeated rows count as often as
they stand there; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import buffers_of, slices, text_column, unclaimed

MAX_LANGUAGES = 10_000  # their counts pass through the driver
SAMPLE = 3000      # rows, over all languages, on which centroids are fitted
DIMS = 4096        # hashed n-grams
CENTROIDS = 4      # per language
SLACK = 0.3        # a text is rejected below this share of the least cosine in its centroid's sample
SURE = 400         # n-grams from which on the whole limit holds; it is in proportion for shorter texts, whose cosine says less
STEP = 1 << 19     # bytes of text turned into counts at once: numpy holds some 80 bytes for each
ROWS = 128         # and texts: their counts are 8 bytes times DIMS each
LETTER = regex.compile(r"\p{L}")

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256, dtype=np.uint8)


@dataclass
class Model:
    languages: list[str]           # of each centroid
    centroids: np.ndarray          # (n, DIMS) float32, unit length
    idf: np.ndarray                # (DIMS,) float32
    limit: np.ndarray              # (n,) least accepted cosine
    training_rows: int = 0
    sample_rows: dict = field(default_factory=dict)


def counts(texts: pa.Array, dims: int = DIMS) -> np.ndarray:
    """(rows, dims) float32 n-gram counts. Each text stands between spaces, so none reaches into the next."""
    data, off = buffers_of(texts)
    folded = _FOLD[data]
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(off))
    space = folded == 32
    again = space.copy()
    again[1:] &= space[:-1]
    if len(data):
        again[off[:-1][np.diff(off) > 0]] &= space[off[:-1][np.diff(off) > 0]]
        starts = off[:-1][np.diff(off) > 0]
        again[starts] = space[starts]  # a leading space is the one put before the text
    keep = ~again
    folded, row = folded[keep], row[keep]
    n = np.bincount(row, minlength=len(texts))
    ends = np.cumsum(n + 3)
    padded = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    place = np.arange(len(folded)) + row * 3 + 1
    padded[place] = folded
    own = np.repeat(np.arange(len(texts), dtype=np.int64), n + 1)  # grams begin at the space before the text and at its bytes
    first = np.arange(len(own)) + own * 2
    p = padded.astype(np.uint32)
    a, b, c = p[first], p[first + 1], p[first + 2]
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    two = ((a * np.uint32(257) + b) * np.uint32(2654435761)) >> shift
    three = (((a * np.uint32(257) + b) * np.uint32(257) + c + np.uint32(77777777)) * np.uint32(2246822519)) >> shift
    base = own * dims
    out = np.bincount(base + two, minlength=len(texts) * dims)
    out += np.bincount(base + three, minlength=len(texts) * dims)
    return out.reshape(len(texts), dims).astype(np.float32)


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(count) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def has_letter(texts: list[str | None]) -> np.ndarray:
    return np.array([t is not None and LETTER.search(t) is not None for t in texts], bool)


def _pieces(batches, col):
    for b in slices(batches, col, STEP):
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _spherical(v: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Unit centroids: farthest-first start, then k-means by cosine."""
    mean = v.mean(0)
    c = [v[int(np.argmax(v @ mean))]]
    while len(c) < min(k, len(v)):
        c.append(v[int(np.argmin((v @ np.array(c).T).max(1)))])
    c = np.array(c)
    for _ in range(rounds):
        near = (v @ c.T).argmax(1)
        c = np.array([v[near == i].sum(0) if (near == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    spark = training.sparkSession
    # copies of a text differ in their other columns, so a large group of copies isn't chosen or left out as a whole
    dice = F.pmod(F.xxhash64(F.lit(7), *[F.col(f"`{c}`") for c in training.columns]), F.lit(1 << 40))
    rows = training.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), dice.alias("dice")).where("lang is not null and text is not null")

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(DIMS, np.int64), {}
        for b in _pieces(batches, "text"):
            total += (counts(text_column(b, "text")) > 0).sum(0)
            for x in b.column("lang").to_pylist():
                seen[x] = seen.get(x, 0) + 1
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([*have.tolist(), *[None] * len(seen)], pa.int32()), pa.array([*[None] * len(have), *seen], pa.string()),
                                          pa.array([*total[have].tolist(), *seen.values()], pa.int64())], names=["i", "lang", "n"])

    df, seen = np.zeros(DIMS, np.int64), {}
    # a task gives DIMS counts and its languages; the driver gets their sums
    for r in rows.select("text", "lang").mapInArrow(frequency, "i int, lang string, n long").groupBy("i", "lang").agg(F.sum("n").alias("n")).collect():
        if r.i is None:
            seen[r.lang] = r.n
        else:
            df[r.i] = r.n
    if len(seen) > MAX_LANGUAGES:
        raise ValueError(f"{len(seen)} languages: more than {MAX_LANGUAGES} are taken for a column of something else")
    total = sum(seen.values())
    idf = (np.log((1 + total) / (1 + df)) + 0.1).astype(np.float32)
    if not seen:
        return Model([], np.zeros((0, DIMS), np.float32), idf, np.zeros(0))
    each = max(1, sample // len(seen))
    share = spark.createDataFrame(pa.table({"lang": pa.array(seen, pa.string()), "share": pa.array([min(1.0, each / n) for n in seen.values()], pa.float64())}))
    chosen = rows.join(F.broadcast(share), "lang").where(F.col("dice") < F.col("share") * (1 << 40)).select("lang", "text")  # one row a language

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches, "text"):
            v = vectors(counts(text_column(b, "text")), idf).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([x.tobytes() for x in v], pa.binary())], names=["lang", "v"])

    got: dict[str, list[np.ndarray]] = {}
    for r in chosen.mapInArrow(features, "lang string, v binary").collect():
        got.setdefault(r.lang, []).append(np.frombuffer(r.v, np.float16))
    names, cent, limit = [], [], []
    for lang in sorted(got):
        v = np.array(sorted(got[lang], key=lambda x: x.tobytes()), np.float32)
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            continue
        c = _spherical(v, k)
        best = v @ c.T
        near = best.argmax(1)
        for i in range(len(c)):
            if (near == i).any():
                names.append(lang)
                cent.append(c[i])
                limit.append(SLACK * best[near == i, i].min())
    return Model(names, np.array(cent, np.float32).reshape(len(names), DIMS), idf, np.array(limit), total, {x: len(v) for x, v in got.items()})


def classify(docs: DataFrame, model: Model, text_col: str = "text", result: str = "langid") -> DataFrame:
    """``docs`` with a last struct ``result`` (lang, score, rejected); an input column called so is an error."""
    unclaimed(docs.columns, result)
    languages, centroids, idf, limit = model.languages, model.centroids.T.copy(), model.idf, model.limit
    told = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    @F.pandas_udf(told)
    def predict(texts):
        import pandas as pd

        lang, score, out = [], [], []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["t"])
        for b in _pieces([batch], "t"):
            ok = has_letter(b.column("t").to_pylist())
            if not languages or not b.num_rows:
                lang += ["und"] * b.num_rows
                score += [0.0] * b.num_rows
                out += [True] * b.num_rows
                continue
            n = counts(text_column(b, "t"))
            sure = np.minimum(n.sum(1) / SURE, 1)
            cos = vectors(n, idf) @ centroids
            near = cos.argmax(1)
            top = np.clip(cos[np.arange(len(near)), near], 0, 1).astype(float)
            lang += [languages[i] if o else "und" for i, o in zip(near, ok)]
            score += np.where(ok, top, 0.0).tolist()
            out += (~ok | (top < limit[near] * sure)).tolist()
        return pd.DataFrame({"lang": lang, "score": score, "rejected": out})

    return docs.withColumn(result, predict(F.col(f"`{text_col}`")))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows to learn from: crc32 of the id as text, modulo 4, isn't 2 (a null id counts as one to learn from)."""
    return docs.where(~held_out(id_col))


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
