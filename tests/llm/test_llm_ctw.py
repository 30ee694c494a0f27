import math
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from helpers import ODD, odd_documents, words

from quarry.llm import ctw, queries


def kt(zeros, ones):
    p, seen = 0.0, [0, 0]
    for bit, n in ((0, zeros), (1, ones)):
        for _ in range(n):
            p += math.log((seen[bit] + 0.5) / (sum(seen) + 1))
            seen[bit] += 1
    return p


class Tree:
    """Context-tree weighting by its definition, one node at a time."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        for text in texts:
            for context, bits in self.decisions(text):
                for d in range(depth + 1):
                    for k in range(8):
                        self.n[context[:d], bits[:k]][bits[k]] += 1
        self.below = defaultdict(set)
        for context, prefix in list(self.n):
            if context:
                self.below[context[:-1], prefix].add(context)

    def decisions(self, text):
        raw = bytes([255] * self.depth) + text.encode() + b"\xff"
        for i in range(self.depth, len(raw)):
            yield raw[i - self.depth:i][::-1], tuple(raw[i] >> (7 - k) & 1 for k in range(8))

    def weighted(self, context, prefix):
        own = kt(*self.n[context, prefix])
        if len(context) == self.depth:
            return own
        return math.log(0.5) + sum_log(own, self.children(context, prefix))

    def children(self, context, prefix):
        return sum(self.weighted(c, prefix) for c in sorted(self.below[context, prefix]))

    def probability(self, context, bits, k):
        p = 0.5
        for d in range(self.depth, -1, -1):
            c = context[:d]
            if (c, bits[:k]) not in self.n:
                p = 0.5
                continue
            zeros, ones = self.n[c, bits[:k]]
            own = (ones + 0.5) / (zeros + ones + 1)
            if d == self.depth:
                p = own
            else:
                share = 1 / (1 + math.exp(self.children(c, bits[:k]) - kt(zeros, ones)))
                p = share * own + (1 - share) * p
        return p if bits[k] else 1 - p

    def log10(self, text):
        return sum(math.log10(self.probability(c, bits, k)) for c, bits in self.decisions(text) for k in range(8))


def sum_log(a, b):
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("resident,chunk", [(6_000_000, 200_000), (0, 3)])
def test_scores_are_those_of_the_tree(spark, monkeypatch, resident, chunk):
    monkeypatch.setattr(ctw, "RESIDENT", resident)  # 0: the model is read chunk by chunk
    monkeypatch.setattr(ctw, "CHUNK_GRAMS", chunk)
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choices(["ab", "abc", "bé", "c"], k=rng.randint(0, 4)))) for i in range(24)]
    tree = Tree([t for i, t in docs if not held(i)], 2)
    got = ctw.scored(spark.createDataFrame(docs, "doc_id long, text string"), depth=2).collect()
    assert {r.doc_id for r in got} == {i for i, _ in docs} and any(held(i) for i, _ in docs)
    for r in got:
        text = dict(docs)[r.doc_id]
        assert r.score == pytest.approx(tree.log10(text), rel=1e-4) and r.train == (not held(r.doc_id))


def test_a_text_of_many_different_bytes_takes_the_same_way():
    text = "".join(chr(c) for c in range(1, 2000)) * 2
    few, many = pa.array(["abab"], pa.large_string()), pa.array(["abab", text], pa.large_string())

    class Fixed(ctw.Scorer):
        def __init__(self):
            self.model = type("M", (), {"depth": 5})

        def log10(self, key):
            assert (key[1:] > key[:-1]).all()
            return -(key % 1009).astype(float)

    assert Fixed().texts(few)[0][0] == Fixed().texts(many)[0][0]


def base(docs):
    n = Counter()
    for i, t in docs:
        if not held(i):
            n.update([*words(t), None])
    total, v = sum(n.values()), len(n)
    out = []
    for i, t in docs:
        own = [*words(t), None]
        out.append((i, len(own), sum(n[w] > 0 for w in own), total, round(sum(math.log10((n[w] + 0.5) / (total + 0.5 * (v + 1))) for w in own), 4)))
    return sorted(out, key=str)


def test_odd_rows(spark):
    docs = odd_documents(spark, ODD)
    got = ctw.scored(docs).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == base(ODD)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert ctw.scored(docs.limit(0)).count() == 0


def test_no_training_rows(spark):
    only = next(i for i in range(100) if held(i))
    r = ctw.scored(spark.createDataFrame([(only, "ab c")], "doc_id long, text string")).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score == pytest.approx(5 * 8 * math.log10(0.5))


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    got = queries.op2_ctw(spark, sf).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == base(docs)
    out = [r for r in got if r.held_out]
    assert out and sum(r.bits_per_byte for r in out) / len(out) < 4
