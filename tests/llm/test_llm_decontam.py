import random

import pytest
from helpers import ALNUM, ODD, odd_documents, words

from quarry.llm import decontam


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text, ALNUM)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text, ALNUM), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    found |= windows[tuple(w[i:i + n])]
                    hit |= set(range(i, i + n))
        out[doc] = (len(w), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def corpus():
    rng = random.Random(7)
    few = [f"t{i}" for i in range(12)]  # a small vocabulary: common terms, overlapping and repeated windows
    items = [(i, " ".join(rng.choices(few, k=rng.choice([0, 1, 2, 3, 9, 10, 14])))) for i in range(25)] + [(None, "t1 T2-t3"), (3, "Éa ß_x"), (99, None)]
    docs = [(i, " ".join(rng.choices(few, k=rng.randint(0, 60)))) for i in range(80)]
    docs += [(100 + i, "pre " + (items[i % 25][1] or "") + " post " + (items[(i + 3) % 25][1] or "")) for i in range(30)] + [(200, "x éa ß X y")]
    return docs, items


@pytest.mark.parametrize("query_bytes,segment", [(16 << 20, 4 << 20), (120, 300)])
def test_exact_matches_are_those_of_all_windows(spark, monkeypatch, query_bytes, segment):
    monkeypatch.setattr(decontam, "QUERY_BYTES", query_bytes)  # small: several passes over the index
    monkeypatch.setattr(decontam, "SEGMENT_BYTES", segment)    # small: many segments
    docs, items = corpus()
    index = decontam.written_index(spark.createDataFrame(docs, "doc_id long, text string"))
    got = decontam.search(index, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == brute(docs, items)
    for r in got:
        assert r.n_hit == sum(b - a for a, b in r.spans) and all(x[1] < y[0] for x, y in zip(r.spans, r.spans[1:]))


def test_proximity(spark):
    docs = [(1, "a x b y c"), (2, "a b c"), (3, "c b a"), (4, "a x x x x b c"), (5, "a b"), (6, "c")]
    index = decontam.written_index(spark.createDataFrame(docs, "doc_id long, text string"))
    got = decontam.search(index, spark.createDataFrame([(9, "a b c")], "item_id long, text string"), slop=2).collect()
    assert {r.doc_id: r.n_hit for r in got} == {1: 5, 2: 3, 3: 0, 4: 0, 5: 0, 6: 0}


def test_odd_rows(spark):
    docs = odd_documents(spark, ODD)
    items = [(1, "w w w"), (2, "ONE"), (3, "日本語")]
    tests = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, terms string")
    got = decontam.search(decontam.written_index(docs), tests).collect()
    expected = brute([(i, t) for i, t in ODD], items)
    assert sorted(((r.doc_id, (r.n_words, r.n_hit, r["items"])) for r in got), key=str) == sorted(((i, expected[i]) for i, _ in ODD), key=str)
    assert decontam.search(decontam.written_index(docs.limit(0)), tests).count() == 0
    assert {r.n_hit for r in decontam.search(decontam.written_index(docs), tests.limit(0)).collect()} == {0}
