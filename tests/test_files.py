"""Files without their contents in a row: listing, hashing by ranges, path index, fetching."""

import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from quarry.operators.profiles import default_config
from quarry.plans import pipeline
from quarry.sources import files as S
from quarry.sources import fixtures

MB = 1 << 20


def write(folder, texts):
    for name, data in texts.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def counting(spark, limit=None):
    """An opener that counts opened files, and fails a read above ``limit`` bytes."""
    opened, open_ = spark.sparkContext.accumulator(0), S.stream_of()

    class Watched:
        def __init__(self, stream):
            self.stream = stream

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def read(self, n=None):
            if limit is not None and (n is None or n > limit):
                raise MemoryError(f"{n} bytes at once")
            return self.stream.read(n) if n is not None else self.stream.read()

    def watched(uri):
        opened.add(1)
        return Watched(open_(uri))

    return opened, watched


def test_a_listing_reads_no_contents(spark, tmp_path):
    write(tmp_path / "in", {"a.txt": b"abc", "x y%20é.html": b"", "sub/c": b"12345"})
    write(tmp_path / "in", {"_SUCCESS": b"", ".hidden/d.txt": b"x", "sub/deep/er/d.pdf": b"1"})
    (tmp_path / "in/nothing").mkdir()
    os.chmod(tmp_path / "in/a.txt", 0)
    for root in (str(tmp_path / "in"), f"file:{tmp_path}/in", f"file://{tmp_path}/in/"):
        df = S.listing(spark, root)
        got = {r.path.split("/in/")[1].lstrip("/"): (r.mime, r.length) for r in df.collect()}
        assert got == {"a.txt": ("text/plain", 3), "x y%20é.html": ("text/html", 0), "sub/c": ("application/octet-stream", 5), "sub/deep/er/d.pdf": ("application/pdf", 1)}
        assert df.where("modified > current_timestamp() - interval 1 hour").count() == 4
    assert S.listing(spark, str(tmp_path / "in/nothing")).count() == 0


def test_a_file_above_the_row_limit_is_hashed_in_ranges(spark, tmp_path):
    big = os.urandom(MB) * 5 + b"end"
    texts = {"big.bin": big, "empty.txt": b"", "x y%20é.txt": "é".encode(), "copy.bin": big}
    write(tmp_path / "in", texts)
    files = S.listing(spark, str(tmp_path / "in"))
    opened, open_ = counting(spark, limit=64 << 10)
    got = sorted(r.sha1 for r in S.hashed(files, range_bytes=64 << 10, open_stream=open_).collect())
    assert got == sorted(hashlib.sha1(t).hexdigest() for t in texts.values())
    assert opened.value >= 4
    assert S.hashed(files.limit(0)).count() == 0
    fetch = S.fetcher(files, row_limit=MB)
    asked = files.select(F.col("file_id").alias("rep"), F.lit("k").alias("sha1"))
    contents = {os.path.basename(r.path): r.content for r in fetch(asked).collect()}
    assert contents["big.bin"] is None and contents["empty.txt"] == b"" and len(contents) == 4


def test_a_file_that_is_gone_ends_the_job(spark, tmp_path):
    write(tmp_path / "in", {"a.txt": b"abc"})
    files = S.listing(spark, str(tmp_path / "in")).withColumn("path", F.concat("path", F.lit("-gone")))
    with pytest.raises(Exception, match="gone"):
        S.hashed(files).collect()


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, {f"f{i}.txt": f"text {i % 7}".encode() for i in range(30)})
    index = S.PathIndex(spark, str(tmp_path / "index"), most=2)
    listed = lambda: S.listing(spark, str(folder))
    opened, open_ = counting(spark)
    first = index.resolve(listed(), open_stream=open_)
    assert first.where("sha1_source = 'computed'").count() == 30 and opened.value == 30
    opened, open_ = counting(spark)
    assert index.resolve(listed(), open_stream=open_).where("sha1_source = 'index'").count() == 30 and opened.value == 0
    time.sleep(0.02)
    write(folder, {"f3.txt": b"text 9", "f4.txt": b"a longer text", "new.txt": b"new"})
    opened, open_ = counting(spark)
    got = {os.path.basename(r.path): (r.sha1, r.sha1_source) for r in index.resolve(listed(), open_stream=open_).collect()}
    assert opened.value == 3 and len(got) == 31
    for name, (sha1, source) in got.items():
        assert sha1 == hashlib.sha1((folder / name).read_bytes()).hexdigest()
        assert (source == "computed") == (name in ("f3.txt", "f4.txt", "new.txt"))
    assert index.entries().count() == 31
    for k in range(3):  # further loads merge runs, entries stay the latest
        time.sleep(0.02)
        write(folder, {"f3.txt": f"again {k}".encode()})
        index.resolve(listed())
    assert index.entries().where("path like '%f3.txt'").first().sha1 == hashlib.sha1(b"again 2").hexdigest()
    assert all(len(v) <= 3 for v in index.runs.live().values())
    assert index.resolve(listed().limit(0)).count() == 0


def test_contents_are_read_once_per_distinct_hash(spark, tmp_path):
    write(tmp_path / "in", {f"f{i}.txt": f" text {i % 4} ".encode() for i in range(20)})
    files = S.PathIndex(spark, str(tmp_path / "index")).resolve(S.listing(spark, str(tmp_path / "in")))
    opened, open_ = counting(spark)
    g = pipeline.generate(spark, files, pipeline.Settings(config=default_config()), fetch=S.fetcher(files, open_stream=open_))
    got = {os.path.basename(r.path): r.content for r in g.join(files.select("file_id", "path"), "file_id").collect()}
    assert got == {f"f{i}.txt": f"text {i % 4}" for i in range(20)}
    assert opened.value == 4


def test_files_written_for_the_queries(spark, tmp_path):
    rows = spark.createDataFrame([("a/1.txt", "é"), ("b/2.txt", None)], "name string, text string")
    fixtures.as_files(rows, str(tmp_path / "out"))
    assert (tmp_path / "out/a/1.txt").read_bytes() == "é".encode() and (tmp_path / "out/b/2.txt").read_bytes() == b""
