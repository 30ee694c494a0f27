"""Line dedup by pairwise alignment.

1. Lines are named by hashes. Beginning at every line, the shortest run of
   lines with at least ``min_words`` words (most often one line) gets a
   128-bit hash: such a run is rare enough to tell that two documents overlap,
   and two documents that share a block of that length share the run at which
   it begins. A run that is not rare is no exception: every holder is paired
   with the earliest holder only, so a run in n documents gives n - 1 pairs.
2. Each pair (later, earlier document) is aligned with patience diff: lines
   that are unique in both documents, their longest increasing chain, extended
   over equal neighbours. Shared runs that the chain leaves out (moved or
   repeated passages) are aligned one by one.
3. Aligned blocks of at least ``min_words`` words are deleted from the later
   document. What repeats inside one document stays, and so does a short line
   beside a run that the run's earliest holder doesn't have there.

"Earlier" is the smaller doc_id. The line hashes of a document are sent once
for some hundred of its partners, not once a pair; only the text itself is
shuffled once, to be cut.

Defined results: null texts stay null, empty texts and texts without words
have no runs; rows with a null doc_id are left as they are; rows that share a
doc_id are never later than each other; other columns are kept as they are
(internal columns have names of their own); an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import scratch, slices, unclaimed

MIN_WORDS = 30   # the least words of a run, and of a deleted block
SALT = 256       # partners of one earlier document that one group aligns


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """(hash of each line without outer white space, its number of words)."""
    lines = text.split("\n")
    return [xxhash.xxh3_64_intdigest(s.strip().encode("utf-8")) for s in lines], [len(s.split()) for s in lines]


def runs(hashes: list[int], words: list[int], least: int) -> list[bytes | None]:
    """For each line with words, the 128-bit hash of the shortest run from it on with ``least`` words; else None."""
    out: list[bytes | None] = []
    to, total, n = 0, 0, len(hashes)
    for i in range(n):
        while to < n and total < least:
            total += words[to]
            to += 1
        if total < least:
            out += [None] * (n - i)
            break
        out.append(xxhash.xxh3_128_digest(np.array(hashes[i:to], np.uint64).tobytes()) if words[i] else None)
        total -= words[i]
    return out


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain that increases in both places (pairs come sorted by the first)."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        i = bisect_left(tails, y)
        back[k] = at[i - 1] if i else -1
        tails[i:i + 1] = [y]
        at[i:i + 1] = [k]
    chain, k = [], at[-1] if at else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


class Earlier:
    """The earlier document of pairs: its lines, where unique ones stand, and where runs begin."""

    def __init__(self, hashes: list[int], words: list[int], least: int):
        self.lines, self.words, self.least = hashes, words, least
        self.place: dict[int, int] = {}
        for i, h in enumerate(hashes):
            self.place[h] = -1 if h in self.place else i
        self.run: dict[bytes, int] = {}
        for i, r in enumerate(runs(hashes, words, least)):
            if r is not None:
                self.run.setdefault(r, i)

    def common(self, hashes: list[int], words: list[int]) -> list[tuple[int, int]]:
        """[from, to) line ranges of the later document to be deleted."""
        a, n, m = self.lines, len(self.lines), len(hashes)
        count: dict[int, int] = {}
        for h in hashes:
            count[h] = count.get(h, 0) + 1
        unique = [(i, self.place[h]) for i, h in enumerate(hashes) if words[i] and count[h] == 1 and self.place.get(h, -1) >= 0]
        mate = [-1] * m
        chain = _increasing(unique)
        for i, j in chain:
            mate[i] = j
        low = -1
        for k, (i, j) in enumerate(chain):  # extend to equal neighbours between the anchors
            low_a = chain[k - 1][1] if k else -1
            x, y = i - 1, j - 1
            while x > low and y > low_a and mate[x] < 0 and hashes[x] == a[y]:
                mate[x] = y
                x, y = x - 1, y - 1
            end, end_a = chain[k + 1] if k + 1 < len(chain) else (m, n)
            x, y = i + 1, j + 1
            while x < end and y < end_a and hashes[x] == a[y]:
                mate[x] = y
                x, y = x + 1, y + 1
            low = x - 1
        gone = [False] * m

        def delete(i: int, to: int) -> None:
            if sum(words[i:to]) >= self.least:
                gone[i:to] = [True] * (to - i)

        i = 0
        while i < m:
            to = i + 1
            if mate[i] >= 0:
                while to < m and mate[to] == mate[to - 1] + 1:
                    to += 1
                delete(i, to)
            i = to
        for i, r in enumerate(runs(hashes, words, self.least)):  # what the chain leaves out
            if r is not None and r in self.run and not gone[i]:
                j, to = self.run[r], i
                while to < m and j < n and hashes[to] == a[j]:
                    to, j = to + 1, j + 1
                delete(i, to)
        out, i = [], 0
        while i < m:
            to = i + 1
            if gone[i]:
                while to < m and gone[to]:
                    to += 1
                out.append((i, to))
            i = to
        return out


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))


def line_table(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc, key, lines binary, words binary, runs array<binary>)`` of documents with an id; key is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out: list[list] = [[], [], []]
            for text in b.column("text").to_pylist():
                h, w = line_hashes(text)
                out[0].append(np.array(h, np.uint64).tobytes())
                out[1].append(np.array(w, np.int32).tobytes())
                out[2].append(list({r for r in runs(h, w, min_words) if r is not None}))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("key"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()),
                                              pa.array(out[2], pa.list_(pa.binary()))], names=["doc", "key", "lines", "words", "runs"])

    schema = T.StructType([T.StructField("doc", docs.schema[id_col].dataType), T.StructField("key", T.LongType()), T.StructField("lines", T.BinaryType()),
                           T.StructField("words", T.BinaryType()), T.StructField("runs", T.ArrayType(T.BinaryType()))])
    return _named(docs, id_col, text_col).where("doc is not null and text is not null").mapInArrow(run, schema)


def _aligned(work: DataFrame, min_words: int) -> DataFrame:
    """``work``: (early, salt, doc, key, lines, words) grouped and sorted, the earlier document's own row (null doc) first."""
    schema = T.StructType([work.schema["doc"], work.schema["key"], T.StructField("cuts", T.ArrayType(T.ArrayType(T.IntegerType()))),
                           T.StructField("n_words", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        early = None
        for b in batches:
            docs, keys, cuts, n = [], [], [], []
            for doc, key, lines, words in zip(*(b.column(k).to_pylist() for k in ("doc", "key", "lines", "words"))):
                lines, words = np.frombuffer(lines, np.uint64).tolist(), np.frombuffer(words, np.int32).tolist()
                if doc is None:
                    early = Earlier(lines, words, min_words)
                    continue
                found = early.common(lines, words)
                if found:
                    docs.append(doc)
                    keys.append(key)
                    cuts.append([list(x) for x in found])
                    n.append(sum(sum(words[x:y]) for x, y in found))
            yield pa.RecordBatch.from_arrays([pa.array(docs, b.schema.field("doc").type), pa.array(keys, pa.int64()),
                                              pa.array(cuts, pa.list_(pa.list_(pa.int32()))), pa.array(n, pa.int64())], names=["doc", "key", "cuts", "n_words"])

    return work.drop("early", "salt").mapInArrow(run, schema)


def find_cuts(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, key, cuts)``: the line ranges to delete from later documents."""
    spark = docs.sparkSession
    path = scratch(spark, "line-dedup")
    line_table(docs, min_words, id_col, text_col).write.parquet(f"{path}/lines")
    lines = spark.read.parquet(f"{path}/lines")
    held = lines.select("doc", "key", F.explode("runs").alias("run"))
    first = held.groupBy("run").agg(F.min(F.struct("doc", "key")).alias("early"), F.count("*").alias("n")).where("n > 1").select("run", "early")
    pairs = held.join(first, "run").where("doc > early.doc").select("early", "doc", "key").distinct()
    pairs.write.parquet(f"{path}/pairs")
    pairs = spark.read.parquet(f"{path}/pairs")
    partners = pairs.groupBy("early").agg(F.expr(f"(count(*) - 1) div {SALT} + 1").alias("salts"))
    seq = lines.select("doc", "key", "lines", "words").dropDuplicates(["doc", "key"])
    own = (partners.join(seq.select(F.struct("doc", "key").alias("early"), "lines", "words"), "early")
           .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
           .select("early", "salt", F.lit(None).cast(lines.schema["doc"].dataType).alias("doc"), F.lit(None).cast("long").alias("key"), "lines", "words"))
    later = (pairs.join(partners, "early").join(seq, ["doc", "key"])
             .select("early", F.pmod(F.xxhash64("doc", "key"), F.col("salts")).alias("salt"), "doc", "key", "lines", "words"))
    work = own.unionAll(later).repartition("early", "salt").sortWithinPartitions("early", "salt", F.col("doc").asc_nulls_first())
    _aligned(work, min_words).write.parquet(f"{path}/cuts")
    return (spark.read.parquet(f"{path}/cuts").groupBy("doc", "key")
            .agg(F.flatten(F.collect_list("cuts")).alias("cuts")))  # at most a range for each line of the document


def cut_text(text: str, cuts: list) -> tuple[str, int, int]:
    """(text without the line ranges, lines deleted, words deleted)."""
    lines = text.split("\n")
    gone = np.zeros(len(lines), bool)
    for x, y in cuts:
        gone[x:y] = True
    return "\n".join(s for s, g in zip(lines, gone) if not g), int(gone.sum()), sum(len(s.split()) for s, g in zip(lines, gone) if g)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", result: str = "line_dedup") -> DataFrame:
    """All rows and columns of ``docs`` with the text cut, and a last struct ``result`` (n_lines, removed_lines, removed_words).

    An input column called ``result`` is an error.
    """
    unclaimed(docs.columns, result)
    cuts = find_cuts(docs, min_words, id_col, text_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc"),
                         F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    joined = packed.join(cuts.hint("merge"), ["doc", "key"], "left")  # the same plan at every size: texts are shuffled once
    told = T.StructType([T.StructField("text", T.StringType()), T.StructField("lines", T.LongType()), T.StructField("words", T.LongType())])

    @F.pandas_udf(told)
    def cut(text, ranges):
        import pandas as pd

        done = [(None, 0, 0) if t is None else cut_text(t, c) for t, c in zip(text, ranges)]
        return pd.DataFrame({"text": [d[0] for d in done], "lines": [d[1] for d in done], "words": [d[2] for d in done]})

    cuttable = F.col("cuts").isNotNull()
    less = joined.withColumn("done", cut(F.when(cuttable, F.col("text")), "cuts"))  # other texts don't leave the JVM
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    return less.select(
        *[(F.when(cuttable, F.col("done.text")).otherwise(F.col("text")) if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns],
        F.struct(n_lines.alias("n_lines"), F.col("done.lines").alias("removed_lines"), F.col("done.words").alias("removed_words")).alias(result))
