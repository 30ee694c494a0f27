"""Token counts from the frequencies of pre-tokens.

A tokenizer cuts a text into pre-tokens and each pre-token, by itself, into
pieces. So the tokens of a text are the sum, over its distinct pre-tokens, of
frequency times number of pieces, and no ids are needed:

1. ``frequencies``: blocks of the corpus become a table. A block lists its
   distinct pre-tokens once; its documents refer to them by code, with a
   frequency each. It is written to the shared folder.
2. ``pieces``: the pre-tokens of all blocks are brought together by a shuffle
   and a sort, and the pieces of each distinct one of the corpus are counted
   once. A pre-token has one row per block at most, so the commonest one is no
   hot key.
3. ``counts``: the numbers go back to the blocks, and every document sums
   frequency times pieces.

Special strings of the tokenizer that occur in a text are one token each, as
the library has it by default. Where the library cuts at white space, letters,
numbers and the rest (byte-level BPE), the ``regex`` module does so faster; a
text with one of the characters that the two classify differently (found by
trying all) is cut by the library. Other tokenizers are used as they are.

Defined results: a null or empty text has no bytes and no tokens; rows with
null or repeated ids are rows of their own; a long text is cut into portions at
white space for its pre-tokens; other columns are not looked at; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import scratch, slices, text_column

MAX_FILE = 64 << 20       # bytes of a tokenizer file; it is sent to every executor
BLOCK_BYTES = 16 << 20    # text whose pre-tokens share a list
BLOCK_TERMS = 1 << 20     # a longer list ends a block early
BLOCK_CHUNKS = 1 << 10    # and more rows
CHUNK_BYTES = 1 << 20     # text whose frequencies are one row
PORTION = 1 << 20         # characters of a long text that are cut at once
PACKED = 1 << 18          # numbers of pieces that are put in order by block before they go back
ROW_GROUP = 8 << 20

# Fixed value: the cut of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AFTER_WORD = regex.compile(r"(?<=\S)(?=\s)")  # no match of PATTERN reaches over such a place, nor looks back over it


def _byte_level(settings: dict) -> bool:
    pre = settings.get("pre_tokenizer") or {}
    return settings.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")


@lru_cache(maxsize=8)
def disagreeing(settings: str) -> str:
    """The characters that the library's byte-level cut and the ``regex`` module put in different classes."""
    import tokenizers

    cut, own, found = tokenizers.Tokenizer.from_str(settings).pre_tokenizer, regex.compile(PATTERN), []
    # planes 4 to 13 hold no characters, 15 and 16 private ones: neither letters nor numbers nor white space
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)]]
    for at in range(0, len(every), 5000):
        chars = every[at:at + 5000]
        text = "".join(f"a{c}1{c}!{c}\n" for c in chars)  # which of the three takes it, if any
        begins = np.zeros(len(text), np.int8)
        begins[[a for _, (a, _) in cut.pre_tokenize_str(text)]] += 1
        begins[[m.start() for m in own.finditer(text)]] -= 1
        found += [chars[k] for k in np.unique(np.flatnonzero(begins) // 7)]
    return "".join(found)


class Cutter:
    """Pre-tokens of texts, and the number of pieces of a pre-token."""

    def __init__(self, settings: str, odd: str):
        import tokenizers

        told = json.loads(settings)
        library = tokenizers.Tokenizer.from_str(settings)
        self.model, self.cut, self.normal = library.model, library.pre_tokenizer, library.normalizer
        added = told.get("added_tokens") or []
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or (a["normalized"] and self.normal) for a in added):
            raise ValueError("special strings that take white space, want word ends or are normalised can't be counted apart")
        self.special = {a["content"] for a in added}
        self.apart = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.byte_level = _byte_level(told)
        if self.byte_level:
            self.own = regex.compile(PATTERN)
            self.odd = frozenset(odd)
            self.bytes = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _portions(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PORTION:
            m = AFTER_WORD.search(text, at + PORTION)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def frequencies(self, text: str) -> Counter:
        """How often each pre-token occurs in the text; special strings stand for themselves."""
        found: Counter = Counter()
        for k, part in enumerate(self.apart.split(text) if self.apart else [text]):
            if k % 2:
                found[part] += 1
            elif part and self.byte_level:
                by_library = not part.isascii() and not self.odd.isdisjoint(part)
                for p in self._portions(part):
                    found.update([p[a:z] for _, (a, z) in self.cut.pre_tokenize_str(p)] if by_library else self.own.findall(p))
            elif part:
                plain = self.normal.normalize_str(part) if self.normal else part
                found.update([p for p, _ in self.cut.pre_tokenize_str(plain)] if self.cut else [plain])
        return found

    def pieces(self, term: str) -> int:
        if term in self.special:
            return 1
        return len(self.model.tokenize(self.bytes.pre_tokenize_str(term)[0][0] if self.byte_level else term))


def _settings(path: str) -> str:
    if os.path.getsize(path) > MAX_FILE:
        raise ValueError(f"{path}: over {MAX_FILE} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


class Shared:
    """One broadcast of the tokenizer; each worker builds its :class:`Cutter` once."""

    def __init__(self, sent):
        self.sent, self.made = sent, []

    def __getstate__(self):
        return {"sent": self.sent, "made": []}

    def cutter(self) -> Cutter:
        if not self.made:
            self.made.append(Cutter(*self.sent.value))
        return self.made[0]


def shared(spark, path: str) -> Shared:
    settings = _settings(path)
    return Shared(spark.sparkContext.broadcast((settings, disagreeing(settings) if _byte_level(json.loads(settings)) else "")))


def _packed(x: np.ndarray) -> bytes:
    """Compressed 32-bit integers, their lowest bytes first, then the next ones."""
    return pa.compress(np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int32)
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n).T).view("<i4").ravel()


def _steps(codes: np.ndarray, n_terms: np.ndarray) -> np.ndarray:
    """Each document's ascending codes as differences to the one before."""
    d = np.diff(codes, prepend=0)
    start = (np.cumsum(n_terms) - n_terms)[n_terms > 0]
    d[start] = codes[start]
    return d


def _codes(steps: np.ndarray, n_terms: np.ndarray) -> np.ndarray:
    up = np.cumsum(steps, dtype=np.int64)
    ends = np.cumsum(n_terms)
    before = np.concatenate([[0], up])[ends - n_terms]
    return up - np.repeat(before, n_terms)


def frequencies(docs: DataFrame, tokenizer: Shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of a block: chunks ``(ids, n_bytes, n_terms, codes, times)`` of its documents, and one row with its ``terms``."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("n_bytes", T.ArrayType(T.LongType())),
                           T.StructField("n_terms", T.ArrayType(T.IntegerType())), T.StructField("codes", T.BinaryType()),
                           T.StructField("times", T.BinaryType()), T.StructField("terms", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = tokenizer.cutter()
        block, size, terms, held, id_type = TaskContext.get().partitionId() << 32, 0, {}, [], None

        def row(ids=None, n_bytes=None, n_terms=None, codes=None, times=None, words=None):
            listed = lambda x, type_: pa.nulls(1, pa.list_(type_)) if x is None else pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays([
                pa.array([block]), listed(ids, id_type), listed(n_bytes, pa.int64()), listed(n_terms, pa.int32()), pa.array([codes], pa.binary()),
                pa.array([times], pa.binary()), listed(words, pa.string())], names=schema.names)

        def ended() -> Iterator[pa.RecordBatch]:
            """The block's rows; codes follow the order of its terms, so that steps between them are small."""
            words = pa.array(terms, pa.string())
            order = pc.sort_indices(words)
            place = np.empty(len(words), np.int64)
            place[order.to_numpy()] = np.arange(len(words))
            for ids, n_bytes, n_terms, codes, times in held:
                new = place[codes]
                by = np.lexsort((new, np.repeat(np.arange(len(n_terms)), n_terms)))
                yield row(ids, n_bytes, pa.array(n_terms), _packed(_steps(new[by], n_terms)), _packed(times[by]))
            yield row(words=words.take(order))

        for b in slices(batches, text_col, CHUNK_BYTES):
            id_type = b.column(id_col).type
            texts, codes, times = text_column(b, text_col), [], []
            n_terms = np.empty(b.num_rows, np.int32)
            for i, text in enumerate(texts):
                found = cutter.frequencies(text.as_py())
                n_terms[i] = len(found)
                codes += [terms.setdefault(t, len(terms)) for t in found]
                times += found.values()
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            held.append((pa.concat_arrays([b.column(id_col)]), n_bytes, n_terms, np.array(codes, np.int32), np.array(times, np.int32)))
            size += pc.sum(n_bytes).as_py()
            if size >= BLOCK_BYTES or len(terms) >= BLOCK_TERMS or len(held) >= BLOCK_CHUNKS:
                yield from ended()
                block, size, terms, held = block + 1, 0, {}, []
        if held:
            yield from ended()

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pieces(terms: DataFrame, tokenizer: Shared) -> DataFrame:
    """``(block, steps, pieces)`` of ``(block, code, term)``: numbers of pieces, by the steps between a block's codes.

    Equal terms meet, and are counted once. The codes of a block that are found
    within ``PACKED`` rows are one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, last, held, size = tokenizer.cutter(), (None, 0), [], 0

        def packed() -> pa.RecordBatch:
            block, code, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((code, block))
            block, code, n = block[order], code[order], n[order]
            start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            ends = pa.array(np.append(start, len(block)), pa.int32())
            steps = _steps(code, np.diff(np.append(start, len(block)))).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(block[start]), pa.ListArray.from_arrays(ends, pa.array(steps)), pa.ListArray.from_arrays(ends, pa.array(n))],
                                              names=["block", "steps", "pieces"])

        for b in batches:
            listed = b.column("term").dictionary_encode()
            words = listed.dictionary.to_pylist()
            n = [last[1] if w == last[0] else cutter.pieces(w) for w in words]  # sorted: only the first can be of the batch before
            if words:
                last = words[-1], n[-1]
                held.append((b.column("block").to_numpy(), b.column("code").to_numpy(), np.array(n, np.int32)[listed.indices.to_numpy()]))
                size += b.num_rows
            if size >= PACKED:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    return terms.repartition("term").sortWithinPartitions("term").mapInArrow(run, "block long, steps array<int>, pieces array<int>")


def counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens)`` of every whole text, by the tokenizer file at ``path`` (.json)."""
    spark = docs.sparkSession
    if not path.endswith(".json"):
        raise ValueError(f"{path}: a tokenizer file of the tokenizers library (.json) is wanted")
    tokenizer = shared(spark, path)
    where = scratch(spark, "pre-tokens")
    frequencies(docs, tokenizer, id_col, text_col).write.option("parquet.block.size", ROW_GROUP).option("compression", "zstd").parquet(where)
    table = spark.read.parquet(where)
    told = pieces(table.where("terms is not null").select("block", F.posexplode("terms").alias("code", "term")), tokenizer)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def total(chunks: pa.Table, found: pa.Table) -> pa.Table:
        n = np.empty(0, np.int64)  # a block of empty texts has no terms
        if found.num_rows:
            steps, each = (pa.concat_arrays(found.column(c).chunks) for c in ("steps", "pieces"))
            code = _codes(steps.flatten().to_numpy(), pc.list_value_length(steps).to_numpy())
            n = np.zeros(len(code), np.int64)
            n[code] = each.flatten().to_numpy()
        out = []
        for r in range(chunks.num_rows):
            row = {k: chunks.column(k)[r] for k in ("ids", "n_bytes", "n_terms", "codes", "times")}
            n_terms = row["n_terms"].values.to_numpy().astype(np.int64)
            m = int(n_terms.sum())
            codes = _codes(_unpacked(row["codes"].as_py(), m), n_terms)
            tokens = np.concatenate([[0], np.cumsum(n[codes] * _unpacked(row["times"].as_py(), m))])
            ends = np.cumsum(n_terms)
            out.append(pa.Table.from_arrays([row["ids"].values, row["n_bytes"].values, pa.array(tokens[ends] - tokens[ends - n_terms], pa.int64())], names=schema.names))
        return pa.concat_tables(out) if out else pa.Table.from_arrays([pa.array([], chunks.schema.field("ids").type.value_type), *[pa.array([], pa.int64())] * 2], names=schema.names)

    chunks = table.where("ids is not null").drop("terms")
    return chunks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(total, schema)
