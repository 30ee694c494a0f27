import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import prefixtrie as trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Rows of (conv_id, turn, role, text), rebuilt and counted by the definition."""
    said = {}
    for c, turn, role, text in rows:
        if c is not None:
            said.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in said.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        rebuilt[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, out = {}, []
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children.get(p, [])) or 1
        saved[p] = sum(saved[k] for k in children.get(p, [])) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    for p, of in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in of if rebuilt[c] == p))
        out.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def told(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def built(spark, rows, band=trie.BAND):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return told(trie.trie(*trie.with_shared_heads(trie.ordered_turns(df)), band))


def test_odd_rows(spark):
    rows = [(5, 0, "u", "hi"), (5, 1, "a", "yo"), (6, 0, "u", "hi"), (6, 1, "a", "yo"), (6, None, "s", "first"), (7, 0, None, None), (7, 0, "", ""), (8, 3, "u", "hi"),
            (8, 3, "u", "hi"), (8, 3, "a", "hi"), (None, 0, "u", "hi"), (-3, 0, "u", "é😀"), (-5, 0, "u", "hi"), (-5, 1, "b", "x" * 5000), (0, 0, "u", "hi"),
            (4, 0, "u", "hi"), (12, 1, "u", "a"), (13, 1, "u:", "a"), (14, 1, "u", ":a"), (10**15 + 3, 0, "u", "hi")]
    assert built(spark, rows) == brute(rows)
    assert built(spark, []) == []
    assert built(spark, [(None, 1, "u", "x")]) == []


def test_other_columns_with_names_used_inside(spark):
    rows = [(c, t, "u", f"{t % 3} {c % 2 if t > 2 else 0}") for c in range(12) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("pos", "part", "row", "depth", "k1", "digest", "n_bytes", "h", "base"):
        df = df.withColumn(name, F.lit("x"))
    assert told(trie.trie(*trie.with_shared_heads(trie.ordered_turns(df)))) == brute(rows)


@pytest.mark.parametrize("band", [2, 3, 16])
def test_long_and_branching_conversations_in_bands(spark, band):
    rng = random.Random(band)
    rows = [(20, t, "u", f"t{t}") for t in range(150)] + [(40, t, "u", f"t{t}" if t < 90 else f"other {t}") for t in range(140)]
    rows += [(c, t, rng.choice("ua"), rng.choice(["x", "yy"])) for c in range(100, 130) for t in range(rng.randint(1, 12))]
    assert built(spark, rows, band) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(20, t, "u", f"t{t}") for t in range(700)] + [(c, t, "u", f"t{t}") for c in (21, 22, 35) for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = trie.ordered_turns(df)
        assert turns.where("conv_id = 20").select(F.min("pos"), F.max("pos"), F.count_distinct("pos")).first() == (1, 700, 700)
        got = told(trie.trie(*trie.with_shared_heads(turns)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute(rows)


def test_running_values_of_keys_that_span_ranges(spark):
    rows = [(k, i, (i * 7919 + k) % 1000) for k, n in ((1, 3), (2, 400), (3, 1), (4, 250)) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, i long, v long").repartition(4)
    for how, op in (("add", lambda a, b: a + b), ("xor", lambda a, b: a ^ b)):
        expected, now = {}, {}
        for k, i, v in sorted(rows):
            now[k] = op(now.get(k, 0), v)
            expected[k, i] = now[k]
        got = trie.running(df, "key", [F.col("i")], [F.col("i")], ["v"], how)
        assert {(r.key, r.i): r.v for r in got.collect()} == expected


def test_one_node_in_which_many_conversations_end(spark, monkeypatch):
    monkeypatch.setattr(trie, "PART_IDS", 64)
    rows = [(c, 0, "u", "same") for c in range(0, 2000, 5)]
    got = built(spark, rows)
    assert got == brute(rows)


def test_a_band_has_two_depths_at_least(spark):
    empty = spark.createDataFrame([], "conv_id long")
    with pytest.raises(ValueError, match="band"):
        trie.trie(empty, empty, 1)
