"""Chat formatting by columnar byte assembly.

The template of a turn is ``<turn ROLE>``, a line feed, the text, a line feed,
``</turn>`` and a line feed. A control string (``<turn `` or ``</turn>``) inside
a text gets a backslash before it; to read the text back, the one backslash
before each control string is taken away. As the template's own control strings
stand after a line feed or at the beginning, they are never taken for escaped
ones. Roles are percent-encoded.

For each Arrow batch, numpy computes the length of every segment (header,
pieces of text between escapes, footer), the cumulative offsets and the index
of every byte, and the bytes are copied once into one preallocated Arrow
buffer, of which the output column is a view.

Rows are ordered by (conversation, turn) over ranges, so that a conversation
that holds a large part of all rows is formatted by several tasks; its text
comes in parts that are in order by ``part``. Parsing reads the parts of a
conversation one after another and holds one part at a time.

Defined results: a null text or role is empty; a null turn comes first; rows of
the same turn are ordered by role and text; repeated rows are turns of their
own; rows with a null conversation id form one conversation; other columns are
not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import buffers_of, from_buffers, ranges, slices, text_column

CONTROLS = (b"<turn ", b"</turn>")
FOOTER = b"\n</turn>\n"
ESCAPE = b"\\"


def control_places(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where control strings begin; one that would reach into the next text is none."""
    found = []
    open_ = np.flatnonzero(data == ord("<"))
    end = off[1:][np.searchsorted(off[1:], open_, side="right")] if len(open_) else open_
    for c in CONTROLS:
        at = open_[open_ + len(c) <= end]
        for k, byte in enumerate(c):
            at = at[data[at + k] == byte]
        found.append(at)
    return np.sort(np.concatenate(found))


def assemble(roles: pa.Array, texts: pa.Array, loss: np.ndarray, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(formatted values, value of each turn, begin and end of each turn's text in its value).

    ``first``: which turns begin a new value.
    """
    n = len(texts)
    data, off = buffers_of(texts)
    names = roles.dictionary_encode()
    heads = [b"<turn " + quote(r, safe="").encode() + b">\n" for r in names.dictionary.to_pylist()]
    head_len = np.array([len(h) for h in heads], np.int64)
    head_at = np.cumsum(head_len) - head_len
    pool = np.frombuffer(b"".join([*heads, FOOTER, ESCAPE]), np.uint8)
    base = len(pool)  # the texts stand behind the pool
    role = names.indices.to_numpy()
    cut = control_places(data, off)
    turn_of_cut = np.searchsorted(off[1:], cut, side="right")
    cuts = np.bincount(turn_of_cut, minlength=n)
    segments = 3 + 2 * cuts  # header, pieces with escapes between them, footer
    at = np.cumsum(segments) - segments
    start, length = np.zeros(int(segments.sum()), np.int64), np.zeros(int(segments.sum()), np.int64)
    start[at], length[at] = head_at[role], head_len[role]
    foot = at + segments - 1
    start[foot], length[foot] = int(head_len.sum()), len(FOOTER)
    nth = np.arange(len(cut)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    escape = at[turn_of_cut] + 2 + 2 * nth
    start[escape], length[escape] = base - 1, 1
    start[at + 1] = base + off[:-1]
    start[escape + 1] = base + cut
    piece_end = base + off[1:]
    last = at + 1 + 2 * cuts
    length[last] = piece_end - start[last]
    length[escape - 1] = base + cut - start[escape - 1]
    upto = np.concatenate([[0], np.cumsum(length)])
    out = pa.allocate_buffer(int(upto[-1]))
    source = np.concatenate([pool, data])
    np.take(source, ranges(start, length), out=np.frombuffer(out, np.uint8))
    value = np.cumsum(first) - 1
    begins = upto[at[first]]
    values = from_buffers(np.frombuffer(out, np.uint8), np.append(begins, upto[-1]))
    return values, value, upto[at + 1] - begins[value], upto[foot] - begins[value]


def conversations_in_parts(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                           text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """``(conv_id, part, n_turns, formatted, loss)``: loss lists the [from, to) bytes of ``formatted`` under the mask."""
    kind = df.schema[conv_col].dataType
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    # the bounds of the ranges pass through the driver: of a role and text, their beginning is enough
    begin = F.substring(F.concat(F.coalesce("role", F.lit("")), F.lit("\0"), F.substring(F.coalesce("text", F.lit("")), 1, 64)), 1, 64)
    rows = rows.repartitionByRange("conv_id", "turn", begin).sortWithinPartitions(*order).select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 40  # partitions are in order
        for b in slices(batches, "text"):
            conv = b.column("conv_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
            first = np.concatenate([[True], conv[1:] != conv[:-1]])
            roles = pc.fill_null(b.column("role").cast(pa.large_string()), "")
            trained = pc.equal(roles, trained_role).to_numpy(zero_copy_only=False)
            values, value, begin, end = assemble(roles, text_column(b, "text"), trained, first)
            m = len(values)
            spans = pa.StructArray.from_arrays([pa.array(begin[trained]), pa.array(end[trained])], names=["from", "to"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(value[trained], minlength=m))]), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([b.column("conv_id").filter(pa.array(first)), pa.array(part + np.arange(m)),
                                              pa.array(np.bincount(value, minlength=m)), values.cast(pa.string()), lists],
                                             names=["conv_id", "part", "n_turns", "formatted", "loss"])
            part += m

    span = T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())])
    return rows.mapInArrow(run, T.StructType([T.StructField("conv_id", kind), T.StructField("part", T.LongType()), T.StructField("n_turns", T.LongType()),
                                              T.StructField("formatted", T.StringType()), T.StructField("loss", T.ArrayType(span))]))


def unescape(data: bytes) -> bytes:
    for c in CONTROLS:
        data = data.replace(ESCAPE + c, c)
    return data


def parse(formatted: bytes) -> list[tuple[str, bytes]]:
    """(role, text) of every turn of a formatted part."""
    out = []
    for turn in formatted.split(FOOTER)[:-1]:
        head, _, text = turn.partition(b">\n")
        out.append((unquote(head[len(CONTROLS[0]):].decode()), unescape(text)))
    return out


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted parts: turns, their digest, and what stands under the loss mask."""
    kind = parts.schema["conv_id"].dataType
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None  # (id, turns, digest, loss characters, digest, characters) of the conversation being read

        def row(c, type_):
            return pa.RecordBatch.from_arrays([pa.array([c[0]], type_), *(pa.array([x]) for x in (c[1], c[2].hexdigest(), c[3], c[4].hexdigest(), c[5]))], names=names)

        type_ = None
        for b in batches:
            type_ = b.schema.field("conv_id").type
            for conv, formatted, loss in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(), b.column("loss").to_pylist()):
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        yield row(open_, type_)
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = formatted.encode()
                for role, text in parse(raw):
                    open_[1] += 1
                    open_[2].update(role.encode() + b"\n" + text + b"\n")
                for span in loss:
                    text = unescape(raw[span["from"]:span["to"]])
                    open_[3] += len(text.decode())
                    open_[4].update(text)
                open_[5] += len(formatted)
        if open_ is not None:
            yield row(open_, type_)

    schema = T.StructType([T.StructField("conv_id", kind), *(T.StructField(n, t) for n, t in zip(names[1:], (
        T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType())))])
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss").mapInArrow(run, schema)
