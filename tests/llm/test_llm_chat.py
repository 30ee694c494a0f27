import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from quarry.llm import chat, queries

PIECES = st.lists(st.sampled_from(["<turn ", "</turn>", "\\", "\n", ">", "<", "a", "é", "😀", "</tur", "\\</turn>", "\n</turn>\n", "### Assistant:"]), max_size=8).map("".join)


def assembled(turns, first):
    roles = pa.array([r for r, _ in turns], pa.large_string())
    texts = pa.array([t for _, t in turns], pa.large_string())
    return chat.assemble(roles, texts, np.ones(len(turns), bool), np.array(first))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), PIECES, PIECES), min_size=1, max_size=6))
def test_formatting_is_reversible(rows):
    first = [k == 0 or new for k, (new, _, _) in enumerate(rows)]
    turns = [(r, t) for _, r, t in rows]
    values, value, begin, end = assembled(turns, first)
    raw = [v.encode() for v in values.to_pylist()]
    assert [x for v in raw for x in chat.parse(v)] == [(r, t.encode()) for r, t in turns]
    for k, (_, text) in enumerate(turns):
        assert chat.unescape(raw[value[k]][begin[k]:end[k]]).decode() == text
    for v in raw:  # control strings of the template alone are bare
        assert v.count(b"\n</turn>\n") == v.count(b"</turn>") - v.count(b"\\</turn>")


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "<turn x></turn>"), (1, None, None, "first"), (2, 0, "assistant", ""), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"),
            (None, 0, "user", "n"), (None, 1, "assistant", "m"), (3, 0, "a>b\n%", "x" * 300000)] + [(4, i, "assistant", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, part string, formatted string")
    parts = chat.conversations_in_parts(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(parts).collect()}
    assert got == expected(rows)
    assert chat.digests(chat.conversations_in_parts(df.limit(0))).count() == 0


def test_a_large_conversation_is_formatted_by_several_tasks(spark):
    rows = [(7, i, "user", "t" * 50) for i in range(20000)]
    parts = chat.conversations_in_parts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(conv_id" in plan
    text = "".join(r.formatted for r in sorted(parts.collect(), key=lambda r: r.part))
    assert text == "<turn user>\n" + ("t" * 50) + "\n</turn>\n" + text[len("<turn user>\n") + 50 + 9:] and text.count("</turn>") == 20000


def test_query_has_the_odd_conversation(spark, sf):
    got = {r.conv_id: r for r in queries.op1_chat(spark, sf).collect()}
    assert (got[-7].n_turns, got[-7].loss_chars) == (2, len(queries.ODD_TEXT))
    assert got[-7].loss_sha256 == hashlib.sha256(r"\### Assistant: </turn> ok".encode()).hexdigest()
