"""Byte-level BPE encoding and decoding by merge replay.

The distinct pieces of a block of the corpus are laid out as one array of
symbols. An inverted index goes from a pair's rank to the positions where the
pair stands; merges are replayed in rank order over all pieces at once, and
after each merge only the touched neighbours get new entries. Every document
then takes the ids of its pieces. There is no shuffle: a lost task repeats its
own blocks only.

Defined results: a null or empty text has no ids; repeated rows, null ids and
very long texts are rows like any other; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import from_buffers, ranges, slices, text_column, trim

NONE = np.int32(2**31 - 1)
MAX_RANK_FILE = 64 << 20  # bytes; the vocabulary is sent to every executor
ENCODE_BYTES = 4 << 20  # text whose pieces are replayed at once
HASHED = 1 << 16        # ids written out at once for their digest


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file (base64 token, rank per line); its size is checked, as it is broadcast."""
    if os.path.getsize(path) > MAX_RANK_FILE:
        raise ValueError(f"{path}: over {MAX_RANK_FILE} bytes")
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Replay:
    """Merge replay over the pieces of a block."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.width = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = rank
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.fromiter(pairs.values(), np.int32, len(pairs))[order]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of symbols a and b; NONE where there is none."""
        if not len(self.keys):
            return np.full(len(a), NONE, np.int32)
        key = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, number of ids of each piece)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(lengths.sum())
        if not n:
            return np.empty(0, np.int32), lengths
        sym = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        right = np.arange(1, n + 1, dtype=np.int64)
        left = np.arange(-1, n - 1, dtype=np.int64)
        ends = np.cumsum(lengths)
        right[ends[lengths > 0] - 1] = -1
        left[(ends - lengths)[lengths > 0]] = -1
        current = np.full(n, NONE, np.int32)  # rank of the pair that begins here
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(at: np.ndarray, rank: np.ndarray) -> None:
            have = rank != NONE
            at, rank = at[have], rank[have]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, group in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if r in index:
                    index[r].append(group)
                else:
                    index[r] = [group]
                    heapq.heappush(heap, r)

        at = np.flatnonzero(right >= 0)
        current[at] = self.rank_of(sym[at], sym[at + 1])
        post(at, current[at])
        while heap:
            r = heapq.heappop(heap)
            groups = index.pop(r)
            at = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
            at = at[current[at] == r]
            if not len(at):
                continue
            if len(at) > 1:  # of pairs that overlap, every second one from the left
                chained = np.concatenate([[False], right[at[:-1]] == at[1:]])
                if chained.any():
                    i = np.arange(len(at))
                    at = at[(i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0]
            gone = right[at]
            after = right[gone]
            sym[at], sym[gone], current[gone] = r, -1, NONE
            right[at] = after
            has = after >= 0
            left[after[has]] = at[has]
            before = left[at]
            touched = np.concatenate([at, before[before >= 0]])
            touched = np.unique(touched) if len(touched) > 1 else touched
            nxt = right[touched]
            rank = np.full(len(touched), NONE, np.int32)
            has = nxt >= 0
            rank[has] = self.rank_of(sym[touched[has]], sym[nxt[has]])
            current[touched] = rank
            post(touched, rank)
        alive = sym >= 0
        counts = np.add.reduceat(np.append(alive, False).astype(np.int64), np.minimum(ends - lengths, n)) if len(pieces) else lengths
        return sym[alive], np.where(lengths > 0, counts, 0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        find, counts = self.pattern.findall, np.empty(len(texts), np.int64)
        code: defaultdict[str, int] = defaultdict()  # numbers the pieces as they come, so that no list of all of them is held
        code.default_factory = code.__len__
        flat = array("i")
        for i, text in enumerate(texts):
            found = find(text)
            counts[i] = len(found)
            flat.extend(map(code.__getitem__, found))
        codes, distinct = np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32), list(code)
        del code
        distinct = [p.encode("utf-8") for p in distinct]
        whole = np.fromiter((self.ranks.get(p, -1) for p in distinct), np.int64, len(distinct))
        rest = np.flatnonzero(whole < 0)
        got, n_got = self.replay([distinct[i] for i in rest])
        n = np.ones(len(distinct), np.int64)
        n[rest] = n_got
        start = np.cumsum(n) - n
        ids = np.empty(int(n.sum()), np.int32)
        ids[start[whole >= 0]] = whole[whole >= 0]
        ids[ranges(start[rest], n_got)] = got
        per_piece = n[codes]
        out = ids[ranges(start[codes], per_piece)]
        upto = np.concatenate([[0], np.cumsum(per_piece)])
        ends = np.cumsum(counts)
        return out, upto[ends] - upto[ends - counts]


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids array<int>)``: the ids of every whole text, as ``encode_ordinary`` of the rank file gives."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(rank_path))
    made: list[Replay] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Replay(ranks.value, pattern))
        for b in slices(batches, text_col, ENCODE_BYTES):
            ids, n = made[0].encode(text_column(b, text_col).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([b.column(id_col), lists], names=[id_col, "ids"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


class Decoder:
    """Bytes of ids, gathered from the tokens of a rank file laid end to end."""

    def __init__(self, ranks: dict[bytes, int]):
        ids = np.fromiter(ranks.values(), np.int64, len(ranks))
        sizes = np.fromiter(map(len, ranks), np.int64, len(ranks))
        self.flat = np.frombuffer(b"".join(ranks), np.uint8)
        self.length, self.start = np.full(int(ids.max()) + 1, -1, np.int64), np.zeros(int(ids.max()) + 1, np.int64)
        self.length[ids], self.start[ids] = sizes, np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray, n: np.ndarray) -> pa.Array:
        """The bytes of each row; ``n``: ids of a row. An unknown id is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or (self.length[ids] < 0).any()):
            raise ValueError("an id that the rank file doesn't have")
        size_of = self.length[ids]
        upto = np.concatenate([[0], np.cumsum(size_of)])
        return from_buffers(self.flat[ranges(self.start[ids], size_of)], upto[np.concatenate([[0], np.cumsum(n)])], pa.large_binary())


def decode(encoded: DataFrame, rank_path: str, keep: list[str]) -> DataFrame:
    """``(*keep, decoded binary)`` of ``ids``; null ids decode to no bytes, an unknown id is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                lists = b.column("ids")
                n = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                text = decoder.decode(lists.flatten().to_numpy().astype(np.int64), n)
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), text.cast(pa.binary())], names=[*keep, "decoded"])
            trim()

    schema = T.StructType([*(encoded.schema[k] for k in keep), T.StructField("decoded", T.BinaryType())])
    return encoded.select(*dict.fromkeys([*keep, "ids"])).mapInArrow(run, schema)


def digests(encoded: DataFrame, rank_path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row: number and digest of the ids, and the digest of the bytes they decode to."""
    told = encoded.select(id_col, F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids")
    return decode(told, rank_path, [id_col, "n_tokens", "ids_sha256"]).select(
        id_col, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What :func:`digests` of :func:`encode` gives, in one worker a task: ids and decoded bytes don't leave it."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(rank_path))
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, decoder = Replay(ranks.value, pattern), Decoder(ranks.value)
        digits = Decoder({f"{i} ".encode(): i for i in range(replay.width)})
        for b in slices(batches, text_col, ENCODE_BYTES):
            ids, n = replay.encode(text_column(b, text_col).to_pylist())
            told, at, one, upto, row = [], 0, np.ones(1, np.int64), np.concatenate([[0], np.cumsum(n)]), 0
            while row < len(n):  # some rows at a time: numpy holds 24 bytes for each byte decoded
                to = max(row + 1, int(np.searchsorted(upto, upto[row] + HASHED, side="right")) - 1)
                for text, k in zip(decoder.decode(ids[upto[row]:upto[to]], n[row:to]), n[row:to].tolist()):
                    own = hashlib.sha256()
                    for a in range(at, at + k, HASHED):  # a long text has long digits: portions of them at a time
                        part = ids[a:min(a + HASHED, at + k)]
                        written = memoryview(digits.decode(part, one * len(part))[0].as_buffer())
                        own.update(written if a + len(part) < at + k else written[:-1])
                    at += k
                    told.append((own.hexdigest(), hashlib.sha256(text.as_buffer()).hexdigest()))
                row = to
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(n, pa.int64()), *(pa.array(x, pa.string()) for x in zip(*told))], names=names)

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           *(T.StructField(x, T.StringType()) for x in names[2:])])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
