"""D3: entities, and markup that isn't closed."""

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.plans import oracle

CASES = [
    ("a &#8217;b&#x2019; &#xZZ; &#; &#0; &#99999999; &#55296;", "a ’b’ &#xZZ; &#; � &#99999999; �"),
    ("&#38;lt; &#38;amp; &amp;lt; &amp;#39; x &#160; y", "&lt; &amp; &lt; &#39; x y"),
    ("&mdash;&hellip;&euro;&auml; &unknown; & &#X1f600;&#128512;", "—…€ä &unknown; & 😀😀"),
    ("<p>one<script>var a = '&lt;'", "one"), ("<!-- open <b>x", ""), ("<style>p{}", ""), ("x<script>1</script>y<SCRIPT type=a>2", "x y"),
    ("<p>&#13;a&#10;b", "a b"), ("plain", "plain"), ("", ""), ("&lt;b&gt; &#39;q&#039; &quot;&apos;", "<b> 'q' \"'"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "page_id long, html string").repartition(2)


def test_body_text(pages):
    got = {r.page_id: r.t for r in pages.select("page_id", H.body_text(F.col("html")).alias("t")).collect()}
    assert [got[i] for i in range(len(CASES))] == [t for _, t in CASES]


def test_the_sql_gives_the_same(pages):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [(i, c) for i, (c, _) in enumerate(CASES)])
    expected = con.execute(f"SELECT page_id, text_sha1, text_chars FROM ({oracle.sql()['q_html_extract']}) ORDER BY 1").fetchall()
    t = H.body_text(F.col("html"))
    assert [tuple(r) for r in pages.select("page_id", F.sha1(t), F.length(t)).orderBy("page_id").collect()] == expected
