import json

import public_tokenizers as P
import pytest
import tokenizers
from helpers import ODD, odd_documents

from quarry.llm import queries, tokencounts

PATH = P.path("byte_bpe_50k.json")
SPECIAL = [(20, "<|endoftext|>"), (21, "a<|endoftext|><|endoftext|> b"), (22, "<|endoftext|"), (23, " <|endoftext|>\n\n x"), (24, "'s 're'll don't  \t x \n"),
           (25, "new letters \U000323b0 \u1c89a1\u1c89 end"), (26, "a \u00a0\u3000 b\u2028c\x85d"), (27, "12\u0663\u00bd x\u0301 \u200d"), (28, "word " * 300000 + " tail"),
           (29, "x" * 1100000 + " y  z")]


def library(texts, path=PATH):
    t = tokenizers.Tokenizer.from_file(path)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def expected(rows, path=PATH):
    return sorted(((i, len((t or "").encode()), n) for (i, t), n in zip(rows, library([t for _, t in rows], path))), key=str)


def test_query_on_documents(spark, sf):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").collect()}
    n = dict(zip(texts, library(texts.values())))
    got = queries.op12_token_counts(spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert told(got) == sorted(((i, len(t.encode()), n[i], n[i] > 512) for i, t in texts.items()), key=str)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_rows(spark, monkeypatch, name):
    rows = ODD + SPECIAL
    docs = odd_documents(spark, rows, ("block", "ids", "n_bytes", "n_terms", "codes", "times", "terms", "term", "code", "pieces"))
    assert told(tokencounts.counts(docs, P.path(name))) == expected(rows, P.path(name))
    assert tokencounts.counts(docs.limit(0), P.path(name)).count() == 0


def test_pieces_are_counted_once_per_pre_token_of_the_corpus(spark, tmp_path):
    rows = [(i, f"alpha beta{i % 7} alpha  gamma") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    tokenizer = tokencounts.shared(spark, PATH)
    table = tokencounts.frequencies(docs, tokenizer)
    table.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.where("terms is not null").count() == 6 == table.select("block").distinct().count()
    terms = table.where("terms is not null").selectExpr("block", "posexplode(terms) as (code, term)")
    assert terms.select("term").distinct().count() == 5 + 7 and terms.count() > 12
    log = spark.sparkContext.accumulator(0)
    made = tokencounts.Cutter.pieces
    try:
        tokencounts.Cutter.pieces = lambda self, term: (log.add(1), made(self, term))[1]
        assert tokencounts.pieces(terms, tokenizer).selectExpr("sum(size(pieces))").first()[0] == terms.count()
    finally:
        tokencounts.Cutter.pieces = made
    assert log.value == 12
    assert told(tokencounts.counts(docs, PATH)) == expected(rows)


def test_a_block_of_empty_texts(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "")], "doc_id long, text string").coalesce(1)
    assert told(tokencounts.counts(docs, PATH)) == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]


def test_blocks_end_early(spark, monkeypatch):
    monkeypatch.setattr(tokencounts, "BLOCK_BYTES", 200)
    monkeypatch.setattr(tokencounts, "CHUNK_BYTES", 60)
    rows = [(i, f"text {i} with some words and {i * i} more") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert tokencounts.frequencies(docs, tokencounts.shared(spark, PATH)).select("block").distinct().count() > 10
    assert told(tokencounts.counts(docs, PATH)) == expected(rows)


def test_long_texts_are_cut_where_pre_tokens_end(monkeypatch):
    monkeypatch.setattr(tokencounts, "PORTION", 7)
    settings = tokencounts._settings(PATH)
    cutter = tokencounts.Cutter(settings, "")
    text = "one two  three \n\n four's   five\u00a0six 77 !! " * 5 + "  "
    assert len(list(cutter._portions(text))) > 5 and "".join(cutter._portions(text)) == text
    whole = tokenizers.Tokenizer.from_str(settings).pre_tokenizer.pre_tokenize_str(text)
    assert sum(cutter.frequencies(text).values()) == len(whole)


def test_characters_that_the_library_does_not_know_yet():
    odd = tokencounts.disagreeing(tokencounts._settings(PATH))
    assert odd and not set("aé日1 \n!\u00a0") & set(odd)


def test_other_files_are_errors(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="json"):
        tokencounts.counts(docs, P.path("piece_bpe_32k.model"))
    told = json.loads(tokencounts._settings(PATH))
    told["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError, match="special strings"):
        tokencounts.Cutter(json.dumps(told), "")
