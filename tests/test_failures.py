"""The failure queries together hold every file, also those of route wrapping."""

import duckdb

import __spark_entry__ as E


def test_failures_of_every_route_are_checked(spark, sf):
    queries, sql = E.queries(), E.oracle_sql()
    names = [n for n in queries if n.startswith("q_search_content_failures")]
    rows = [r for n in names for r in queries[n](spark, sf).collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    expected = [r for n in names for r in con.execute(f"SELECT doc_id, route, content_sha1, n_properties FROM ({sql[n]})").fetchall()]
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.route, r.content_sha1, r.n_properties)) for r in rows)
    wrapping = [r for r in rows if r.route == "wrapping"]
    assert {r.n_properties for r in wrapping} == {None, 0, 4} and any(r.content_sha1 is None for r in wrapping) and any(r.content_sha1 for r in wrapping)
