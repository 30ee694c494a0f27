"""Filter interaction audit by contractions of contingency tensors.

Each document fails some of n filters. Documents are counted per part and set
of failed filters: at most 2^n cells a part, each with the number of documents,
of good and of toxic ones. The cells of a part, reshaped to a 2 x ... x 2 tensor
(index 0: passes the filter, 1: fails it), are contracted for every step of
every order of the filters: along each axis one vector selects the documents
that pass, that fail, or all. No document is looked at again, however many
orders there are.

The filter ``copies`` fails a text that a smaller doc_id has too. Texts are
compared by their SHA-256. Rows are counted per (text, part, labels) with the
smallest doc_id before they meet, so a group of copies sends a few rows a task
however many members it has; of a text, only the digest is shuffled.

Defined results: a null text is empty, a null part is the empty string; rows
with a null doc_id are never later than another and make no row fail; rows
that share a doc_id are documents of their own, none smaller than the other. A
document is good (toxic) if any of its label rows says so; null labels say
nothing. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_FILTERS = 6  # 720 orders, 64 cells
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
BATCH_PARTS = 64


def text_filters(min_words: int = 100, distinct_percent: int = 80, upper_percent: int = 10, symbols: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions on the columns ``text`` and ``words``: few words, repeated words, capitals, symbols."""
    n = F.size("words")
    return {
        "A": n < min_words,
        "B": 100 * F.size(F.array_distinct("words")) < distinct_percent * n,
        "C": 100 * (F.length("text") - F.length(F.translate("text", UPPER, ""))) > upper_percent * F.length("text"),
        "D": F.length(F.translate("text", symbols, "")) < F.length("text"),
    }


def cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str | None = None, part_col: str = "lang") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and failed filters; bit k of ``mask`` is filter k in alphabetical order."""
    names = sorted([*filters, *([copies] if copies else [])])
    if not 1 <= len(names) <= MAX_FILTERS or len(set(names)) < len(filters) + bool(copies) or any(len(x) != 1 for x in names):
        raise ValueError(f"1 to {MAX_FILTERS} filters with names of one letter are wanted, each once")
    mask = sum((F.when(F.coalesce(c, F.lit(False)), 1 << names.index(x)).otherwise(0) for x, c in filters.items()), F.lit(0))
    told = (docs.select("doc_id", F.coalesce(part_col, F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
            .select("doc_id", "part", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
            .select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")))
    said = labels.groupBy("doc_id").agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c) for c in ("quality", "toxic")))
    no = F.lit(False)
    told = told.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    known = told.where("doc_id is not null").join(said.where("doc_id is not null").hint("merge"), "doc_id", "left").select(
        "doc_id", "part", "mask", "digest", "n", F.coalesce("quality", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    rows = known.unionAll(told.where("doc_id is null").select("doc_id", "part", "mask", "digest", "n", no.alias("good"), no.alias("toxic")))
    if copies:
        same = rows.groupBy("digest", F.col("doc_id").isNull().alias("unnamed"), "part", "mask", "good", "toxic").agg(
            F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
        least = F.min("first.doc_id").over(Window.partitionBy("digest"))  # one row per part and labels, whatever the number of copies
        same = same.select("*", F.when(F.col("unnamed"), F.col("n")).when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0).alias("firsts"))
        bit = 1 << names.index(copies)
        rows = same.select("part", "good", "toxic", F.explode(F.array(
            F.struct("mask", F.col("firsts").alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))).alias("c"))
        rows = rows.select("part", "good", "toxic", "c.mask", "c.n").where("n > 0")
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(
        F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def contracted(tensor: np.ndarray, orders: list[tuple[int, ...]]) -> np.ndarray:
    """(7 counts of ``COUNTS``, parts, orders, steps) of ``tensor`` (3 counts, parts, 2, ..., 2)."""
    n = tensor.ndim - 2
    order = np.array(orders)
    place = np.argsort(order, axis=1)                       # (orders, filter): its step
    step = np.arange(n)[None, :, None]
    place = np.broadcast_to(place[:, None, :], (len(orders), n, n)).reshape(-1, n)
    step = np.broadcast_to(step, (len(orders), n, n)).reshape(-1, n)
    passed, failed, any_ = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])

    def chosen(where: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
        return np.where(where[..., None], yes, no)          # (orders * steps, filter, 2)

    here, before = place == step, place < step
    axes = "abcdefgh"[:n]
    rule = f"kp{axes}," + ",".join(f"s{x}" for x in axes) + "->kps"

    def count(select: np.ndarray) -> np.ndarray:
        return np.einsum(rule, tensor, *(select[:, i] for i in range(n)))

    kept = count(chosen(here | before, passed, any_))[0]
    gone = count(chosen(here, failed, chosen(before, passed, any_)))
    failing = count(chosen(here, failed, any_))[0]
    unique = count(chosen(here, failed, passed))[0]
    parts = tensor.shape[1]
    shapley = np.zeros((parts, n), np.int64)
    filter_at = order.reshape(-1)                           # filter of each (order, step)
    np.add.at(shapley, (slice(None), filter_at), gone[0])
    return np.stack([kept, gone[0], failing - gone[0], unique, gone[1], gone[2], shapley[:, filter_at]]).reshape(len(COUNTS), parts, len(orders), n)


def audit(counted: DataFrame, names: str) -> DataFrame:
    """``(part, filter_order, step, *COUNTS)`` for every part, order of ``names`` and step, from the rows of :func:`cells`."""
    names = "".join(sorted(names))
    n = len(names)
    orders = list(permutations(range(n)))
    words = ["".join(names[i] for i in o) for o in orders]
    cell = F.collect_list(F.struct("mask", "n", "good", "toxic"))  # 2^n at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_PARTS):
                b = whole.slice(at, BATCH_PARTS)
                lists, parts = b.column("cells"), b.num_rows
                part = np.repeat(np.arange(parts), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                flat = {k: v.to_numpy() for k, v in zip([f.name for f in flat.type], flat.flatten())}
                tensor = np.zeros((3, parts, 2 ** n), np.int64)
                for k, name in enumerate(("n", "good", "toxic")):
                    tensor[k, part, flat["mask"]] = flat[name]
                # bit k of the mask is axis k: the last bit comes first in memory
                tensor = tensor.reshape(3, parts, *[2] * n).transpose(0, 1, *range(n + 1, 1, -1))
                done = contracted(tensor, orders)
                each = len(orders) * n
                yield pa.RecordBatch.from_arrays([
                    b.column("part").take(pa.array(np.repeat(np.arange(parts), each))), pa.array(np.repeat(words, n).tolist() * parts),
                    pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), parts * len(orders))), *(pa.array(x.reshape(-1)) for x in done)],
                    names=["part", "filter_order", "step", *COUNTS])

    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return counted.groupBy("part").agg(cell.alias("cells")).mapInArrow(run, schema)
