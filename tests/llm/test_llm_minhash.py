import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, odd_documents, shingles, smallest

from quarry.llm import minhash
from quarry.llm.graph import components


def brute(docs, width, percent):
    sets = {i: shingles(t, width) for i, t in docs if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c, c == i) for i, c in smallest(ids, links).items()}


def near_copies(n, seed=1):
    """A base, copies with few to many changed words, exact copies, and unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = rng.choices(vocabulary, k=120)
    docs = [(5000, " ".join(base))]
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        docs.append((10 + i, " ".join(own)))
    docs += [(6000 + i, docs[i % 5][1].upper()) for i in range(40)]
    docs += [(7000 + i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 90)))) for i in range(60)]
    return docs


@pytest.mark.parametrize("block,width,percent", [(500, 3, 85), (15, 5, 80)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, block, width, percent):
    monkeypatch.setattr(minhash, "BLOCK", block)  # small: a bucket is cut into many pairs of blocks
    docs = near_copies(150)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), minhash.Params(shingle=width, percent=percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(docs, width, percent)


def test_odd_rows(spark):
    got = minhash.near_duplicates(odd_documents(spark, ODD), minhash.Params(shingle=3, percent=85)).collect()
    expected = brute(ODD, 3, 85)
    assert len(got) == len(ODD)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (expected[r.doc_id] if r.doc_id is not None else (4, None, True))
    assert minhash.near_duplicates(odd_documents(spark, ODD).limit(0)).count() == 0


def test_sequential_test_keeps_pairs_above_the_threshold():
    p = minhash.Params()
    least = minhash.least_matches(p)
    rng = np.random.default_rng(0)
    for similarity, low, high in ((0.9, 1.0, 1.0), (0.82, 0.9999, 1.0), (0.3, 0.0, 0.0)):
        a = rng.integers(0, 2**32, (20000, p.size), dtype=np.uint32)
        b = np.where(rng.random(a.shape) < similarity, a, a + 1).astype(np.uint32)
        assert low <= len(minhash.survivors(a, b, p, least)) / 20000 <= high


def test_sets_do_not_depend_on_the_batch():
    texts = ["a b c d", "", "a", "b c d e f", "a b c d"]
    h, off = minhash.shingle_sets(pa.array(texts, pa.large_string()), 3)
    for i, t in enumerate(texts):
        own, _ = minhash.shingle_sets(pa.array([t], pa.large_string()), 3)
        assert h[off[i]:off[i + 1]].tolist() == own.tolist() and len(own) == len(shingles(t, 3))


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = smallest({x for e in links for x in e}, links)
    assert got == {n: expected[n] for e in links if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
