"""Benchmark decontamination by a positional inverted index.

``build_index`` turns the training texts into index segments, one row each:
the sorted positions of every token (postings), and where each document lies.
The segments are written to the shared folder, so a lost task re-reads one
file. ``search`` takes the test texts cut into windows. Corpus frequencies of
their terms come from the index; in every segment the posting lists of a
window's terms are shifted by the term's offset and intersected, beginning with
the term that is rarest in the corpus. What is left are the places where the
phrase begins. With ``slop`` it also returns ordered proximity matches: the
window's terms in their order, with at most ``slop`` other words between them.

No shuffle is needed for the search, a common term or passage only makes the
segments that hold it longer to search, and no list is cut. The windows are
sent to every executor in blocks of at most ``QUERY_BYTES`` of test text; more
test text takes more passes over the index.

Defined results: a null or empty text has no words and no hits; a test item
without words gives no window; a test item with a null id counts as hit words
but isn't listed; repeated ids are rows of their own (documents) or one item
(test items); other columns are not looked at; empty tables give no rows, or
rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import ALNUM, coded, gathered, ranges, scratch, text_column, words_of

SEGMENT_BYTES = 2 << 20   # text per index segment
QUERY_BYTES = 4 << 20     # test text per pass over the index: some 50 MB of windows, sent to every executor
ROW_GROUP = 8 << 20       # of the index files: their writer holds one
INDEX = "segment string, docs binary, first binary, words binary, terms array<string>, ends binary, positions binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index segments over whole texts. A word's position counts all words of the segment before it, and one gap per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, b in enumerate(gathered(batches, text_col, SEGMENT_BYTES)):
            flat, off = words_of(text_column(b, text_col), ALNUM)
            count = np.diff(off)
            first = off[:-1] + np.arange(len(count))  # one unused position after each document
            codes, terms = coded(flat)
            order = np.argsort(codes, kind="stable")
            at = (np.arange(len(codes)) + np.repeat(np.arange(len(count)), count))[order]
            ends = np.cumsum(np.bincount(codes, minlength=len(terms))) if len(terms) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{i}"]), pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(id_col)),
                pa.array([first.astype(np.int64).tobytes()]), pa.array([count.astype(np.int64).tobytes()]),
                pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms.cast(pa.string())),
                pa.array([ends.astype(np.int64).tobytes()]), pa.array([at.astype(np.int32).tobytes()])],
                names=["segment", "docs", "first", "words", "terms", "ends", "positions"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("segment", T.StringType()), T.StructField("docs", T.ArrayType(kind)),
                           T.StructField("first", T.BinaryType()), T.StructField("words", T.BinaryType()),
                           T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("ends", T.BinaryType()),
                           T.StructField("positions", T.BinaryType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


class Windows:
    """The distinct windows of a block of test texts, as rows of term codes, and the items that hold each."""

    def __init__(self, items: list, texts: pa.Array, width: int):
        flat, off = words_of(texts, ALNUM)
        codes, self.terms = coded(flat)
        self.width, count = width, np.diff(off)
        each = np.where(count > 0, np.maximum(count - width + 1, 1), 0)  # windows of an item
        item = np.repeat(np.arange(len(count), dtype=np.int32), each)
        start = ranges(off[:-1], each)
        length = np.minimum(count, width)[item]
        term = np.full((len(item), width), -1, np.int32)
        for k in range(width):
            has = k < length
            term[has, k] = codes[start[has] + k]
        self.term, which = np.unique(term, axis=0, return_inverse=True) if len(item) else (term, np.empty(0, np.int64))
        self.length = (self.term >= 0).sum(1)
        named = np.array([x is not None for x in items], bool)[item]
        held = np.unique(np.stack([which.reshape(-1)[named], item[named]]), axis=1)
        self.listed = items
        self.item, self.item_ends = held[1].astype(np.int32), np.cumsum(np.bincount(held[0], minlength=len(self.term)))

    def rank(self, frequency: np.ndarray) -> None:
        """Put each window's offsets in the order of their terms' corpus frequency, rarest first."""
        f = np.where(self.term >= 0, np.append(frequency, 0)[self.term], np.iinfo(np.int64).max)
        self.order = np.argsort(f, axis=1, kind="stable").astype(np.int16)


def items_of(w: Windows, window: int) -> list:
    return [w.listed[i] for i in w.item[w.item_ends[window - 1] if window else 0:w.item_ends[window]]]


def _postings(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ends"], np.int64), np.frombuffer(row["positions"], np.int32)


def phrases(w: Windows, start: np.ndarray, count: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, position where it begins) of all exact occurrences; start, count: each term's list in ``positions``."""
    rarest = np.take_along_axis(w.term, w.order[:, :1], 1)[:, 0]
    whole = np.where(w.term >= 0, count[w.term], 1).min(1) > 0  # all terms occur
    at = np.flatnonzero(whole)
    n = count[rarest[at]]
    window = np.repeat(at, n)
    begin = positions[ranges(start[rarest[at]], n)].astype(np.int64) - w.order[window, 0]
    # one key per posting, ascending: lists stand one after another, each sorted
    span = int(positions.max(initial=0)) + w.width + 2
    listed = np.flatnonzero(count > 0)
    by_start = listed[np.argsort(start[listed], kind="stable")]
    turn = np.zeros(len(count), np.int64)
    turn[by_start] = np.arange(len(by_start))
    key = np.repeat(np.arange(len(by_start)), count[by_start]) * span + positions[ranges(start[by_start], count[by_start])]
    for k in range(1, w.width):
        if not len(window):
            break
        more = k < w.length[window]
        offset = w.order[window, k]
        term = w.term[window, offset]
        place = begin + offset
        want = turn[term] * span + np.maximum(place, 0)
        found = key[np.minimum(np.searchsorted(key, want), len(key) - 1)] == want
        keep = ~more | (found & (place >= 0))
        window, begin = window[keep], begin[keep]
    keep = begin >= 0
    return window[keep], begin[keep]


def near(w: Windows, start: np.ndarray, count: np.ndarray, positions: np.ndarray, doc_of, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, first, last position) where the terms stand in order with at most ``slop`` words between them, greedily from each first term."""
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for i in range(len(w.length)):
        terms = w.term[i, :w.length[i]]
        if (count[terms] == 0).any():
            continue
        begin = at = positions[start[terms[0]]:start[terms[0]] + count[terms[0]]].astype(np.int64)
        for t in terms[1:]:
            own = positions[start[t]:start[t] + count[t]].astype(np.int64)
            j = np.searchsorted(own, at, side="right")
            ok = j < len(own)
            begin, at = begin[ok], own[j[ok]]
            ok = (at - begin + 1 <= w.length[i] + slop) & (doc_of(at) == doc_of(begin))
            begin, at = begin[ok], at[ok]
        if len(begin):
            found.append((i, begin, at))
    if not found:
        e = np.empty(0, np.int64)
        return e, e, e
    return (np.repeat([f[0] for f in found], [len(f[1]) for f in found]), np.concatenate([f[1] for f in found]),
            np.concatenate([f[2] for f in found]))


def term_frequency(index: DataFrame, terms: list[str]) -> np.ndarray:
    """Corpus frequency of the given terms, from the index."""
    wanted = index.sparkSession.sparkContext.broadcast(pa.array(terms, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for b in batches:
            for row in range(b.num_rows):
                have = b.column("terms")[row].values
                if have is None or not len(have):
                    continue
                n = np.diff(np.frombuffer(b.column("ends")[row].as_py(), np.int64), prepend=0)
                at = pc.index_in(wanted.value, value_set=have)
                known = pc.is_valid(at).to_numpy(zero_copy_only=False)
                total[known] += n[at.drop_null().to_numpy()]
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(total[i], pa.int64())], names=["i", "n"])

    out = np.zeros(len(terms), np.int64)
    for r in index.select("terms", "ends").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r.i] = r.n
    wanted.destroy()
    return out


def _pass(index: DataFrame, w: Windows, item_type: T.DataType, slop: int | None) -> DataFrame:
    """Spans and items of every document of the index for one block of windows."""
    sent = index.sparkSession.sparkContext.broadcast(SimpleNamespace(**vars(w)))
    id_type = index.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("segment", T.StringType()), T.StructField("row", T.LongType()),
                           T.StructField("n_words", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(item_type))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        w = sent.value
        for b in batches:
            for i in range(b.num_rows):
                row = {k: b.column(k)[i].as_py() for k in ("segment", "first", "words", "ends", "positions")}
                ids, have = b.column("docs")[i].values, b.column("terms")[i].values
                first, words = np.frombuffer(row["first"], np.int64), np.frombuffer(row["words"], np.int64)
                ends, positions = _postings(row)
                n = np.diff(ends, prepend=0)
                at = pc.index_in(w.terms.cast(pa.string()), value_set=have) if len(have) else pa.nulls(len(w.terms), pa.int32())
                known = pc.is_valid(at).to_numpy(zero_copy_only=False)
                start, count = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
                j = at.drop_null().to_numpy()
                count[known], start[known] = n[j], ends[j] - n[j]
                doc_of = lambda p: np.searchsorted(first, p, side="right") - 1
                if not len(w.length):
                    window = begin = last = np.empty(0, np.int64)
                elif slop is None:
                    window, begin = phrases(w, start, count, positions)
                    last = begin + w.length[window] - 1
                else:
                    window, begin, last = near(w, start, count, positions, doc_of, slop)
                spans: list[list] = [[] for _ in words]
                items: list[set] = [set() for _ in words]
                doc = _last_with_words(doc_of(begin), words)
                order = np.lexsort((last, begin))
                for k in order.tolist():  # occurrences only
                    d = int(doc[k])
                    a, z = int(begin[k] - first[d]), int(last[k] - first[d]) + 1
                    own = spans[d]
                    if own and a <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], z)
                    else:
                        own.append([a, z])
                    items[d].update(items_of(w, window[k]))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([row["segment"]] * len(ids)), pa.array(np.arange(len(ids))), pa.array(words), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array([list(x) for x in items], pa.list_(to_arrow_type(item_type)))], names=["doc_id", "segment", "row", "n_words", "spans", "items"])

    return index.mapInArrow(run, schema)


def _last_with_words(doc: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Every document has its own first position, so the document found is the one; kept as a check."""
    assert not len(doc) or (words[doc] > 0).all()
    return doc


def search(index: DataFrame, tests: DataFrame, width: int = 10, item_col: str = "item_id", text_col: str = "text",
           slop: int | None = None) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans)`` for every document of the index.

    ``spans``: [from, to) word ranges that windows cover, merged; ``items``: the
    test items that occur, sorted as strings.
    """
    tests = tests.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    item_type = tests.schema["item"].dataType
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(size) // QUERY_BYTES
    found = None
    for k in range(n):  # one pass unless the test set is over QUERY_BYTES
        part = tests.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).toArrow()
        w = Windows(part["item"].to_pylist(), text_column(part.combine_chunks().to_batches()[0] if part.num_rows else
                    pa.RecordBatch.from_pylist([], schema=part.schema), "text"), width)
        w.rank(term_frequency(index, w.terms.to_pylist()))
        one = _pass(index, w, item_type, slop)
        found = one if found is None else found.unionAll(one)
    if n > 1:
        found = found.groupBy("segment", "row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),  # n entries a document
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = found.withColumn("spans", F.expr(
            "aggregate(spans, cast(array() as array<array<bigint>>), (m, s) -> if(size(m) > 0 and s[0] <= element_at(m, -1)[1], "
            "concat(slice(m, 1, size(m) - 1), array(array(element_at(m, -1)[0], greatest(element_at(m, -1)[1], s[1])))), concat(m, array(s))))"))
    as_text = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words",
                        F.expr("aggregate(spans, 0L, (n, s) -> n + s[1] - s[0])").alias("n_hit"), as_text.alias("items"), "spans")


def written_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index, stored as Parquet in the shared folder and read back."""
    spark = docs.sparkSession
    path = scratch(spark, "positional-index")
    build_index(docs, id_col, text_col).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.parquet(path)
