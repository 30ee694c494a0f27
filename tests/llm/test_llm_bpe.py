import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from helpers import ODD, odd_documents

from quarry.llm import bpe, queries

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_replay_is_the_librarys_encoding(library):
    texts = ["", "a" * 1000, "aaaa" * 7 + "aaa", "abababab", "  a  b\n\n\n c\t", "the" * 500, "日本語😀é", "x" * 3001, "1234567890" * 9, "'s 're'll don't"]
    ids, n = bpe.Replay(bpe.load_ranks(PATH), P.PATTERN).encode(texts)
    at = 0
    for text, k in zip(texts, n.tolist()):
        assert ids[at:at + k].tolist() == library.encode_ordinary(text), text[:20]
        at += k


def test_a_lower_rank_that_appears_later_is_merged_next():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abc": 257, b"cd": 258}
    replay = bpe.Replay(ranks, r"\w+")
    assert replay.replay([b"abcd", b"cd", b"bcbc"])[0].tolist() == [257, ord("d"), 258, 256, 256]


def test_query_on_documents(spark, sf, library):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    got = queries.op8_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_rows(spark, library):
    docs = odd_documents(spark, ODD)
    got = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH, ["doc_id", "ids"]).collect()
    assert sorted(((r.doc_id, bytes(r.decoded).decode(), list(r.ids)) for r in got), key=str) == sorted(
        ((i, t or "", library.encode_ordinary(t or "")) for i, t in ODD), key=str)
    assert bpe.digests(bpe.encode(docs.limit(0), PATH, P.PATTERN), PATH).count() == 0


def test_one_worker_gives_the_same_digests(spark):
    docs = odd_documents(spark, [*ODD, (11, "wort 12 " * 40000)])
    apart = bpe.digests(bpe.encode(docs, PATH, P.PATTERN), PATH)
    whole = bpe.round_trip(docs, PATH, P.PATTERN)
    assert whole.columns == apart.columns
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)
    assert bpe.round_trip(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_unknown_ids_are_errors(spark):
    with pytest.raises(Exception, match="doesn't have"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), PATH, ["doc_id"]).collect()
