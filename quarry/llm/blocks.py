"""Arrow helpers shared by the operators: bounded blocks of rows and vectorised words."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 8 << 20  # text handled at once by a Python worker; a longer single text is a block of its own


BATCH_BYTES = 3 << 20  # of an Arrow batch between the JVM and a Python worker


def bound_batches(spark) -> None:
    """Smaller Arrow batches than Spark's default: several workers and the JVM hold one or two of them each at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as large strings (64-bit offsets); null texts become empty."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def buffers_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large string array, offsets starting at 0."""
    off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def from_buffers(data: np.ndarray, offsets: np.ndarray, kind=None) -> pa.Array:
    """A large string (or ``kind``) array over the given bytes."""
    return pa.Array.from_buffers(kind or pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def trim() -> None:
    """Give freed memory back to the system: workers of several stages live side by side in an executor."""
    pa.default_memory_pool().release_unused()
    free = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if free is not None:
        free(0)


def slices(batches: Iterator[pa.RecordBatch], name: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds at most ``max_bytes`` of ``name`` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, ends = 0, np.cumsum(size)
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield b.slice(at, to - at)
            trim()
            at = to


def gathered(batches: Iterator[pa.RecordBatch], name: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Like :func:`slices`, and neighbouring small pieces are joined up to ``max_bytes``."""
    held, size = [], 0
    for b in slices(batches, name, max_bytes):
        n = pc.sum(pc.fill_null(pc.binary_length(b.column(name)), 0)).as_py() or 0
        if held and size + n > max_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
            trim()
        held.append(b)
        size += n
    if held:
        yield pa.concat_batches(held)


def _table(word: np.ndarray) -> np.ndarray:
    """Byte map: A-Z to a-z, bytes that are not of a word to a space."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[~word] = 32
    return t


_not_space = np.ones(256, bool)
_not_space[[32, *range(9, 14)]] = False
_alnum = np.zeros(256, bool)
_alnum[0x30:0x3A] = _alnum[0x61:0x7B] = _alnum[0x41:0x5B] = _alnum[0x80:] = True
SPACED = _table(_not_space)  # words [^\x20\x09-\x0D]+
ALNUM = _table(_alnum)       # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+


def words_of(texts: pa.Array, table: np.ndarray = SPACED) -> tuple[pa.Array, np.ndarray]:
    """(all words of all texts in order, offsets of each text's words); A-Z lower-cased."""
    data, off = buffers_of(texts)
    split = pc.ascii_split_whitespace(from_buffers(table[data], off))
    flat, ends = split.flatten(), split.offsets.to_numpy()
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if keep.all():
        return flat, ends - ends[0]
    before = np.concatenate([[0], np.cumsum(keep)])
    return flat.filter(pa.array(keep)), before[ends - ends[0]]


def coded(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code of each word, distinct words)."""
    d = flat.dictionary_encode()
    return d.indices.to_numpy(), d.dictionary


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each (start, length), one after another."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def free(columns: list, name: str) -> str:
    """``name``, or with ``_`` behind it until no column is called so."""
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def unclaimed(columns: list, name: str) -> str:
    """``name`` for a result column; an input column of that name is an error."""
    if free(columns, name) != name:
        raise ValueError(f"the input has a column {name}: give the result column another name")
    return name


def scratch(spark, name: str) -> str:
    """A new folder for a written table, below the shared folder of ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("spark.checkpoint.dir isn't set: it names the folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
