"""Relations derived from the given tables (FIXTURES.md), as DataFrames.

Every relation here is a narrow projection of a driver table (or a window
over one), so its size grows with the table it reads.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.functions import meta
from quarry.sources.tables import table

# Fixed MIME assignment of the `files` fixture (FIXTURES.md §2).
MIME_BY_RESIDUE = ["text/plain", "application/pdf", "image/jpeg",
                   "application/msword", "application/x-blocked", "audio/mpeg"]


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document: path, MIME, native text and native metadata.

    ``native_meta`` is the native handler's formatted metadata as
    ``struct<visible, collapsed>`` (NULL when the handler produced none).
    """
    return files_from(table(spark, sf_dir, "documents"))


def files_from(d: DataFrame) -> DataFrame:
    """:func:`files` over any frame with the ``documents`` columns (batch or stream)."""
    r6 = F.col("doc_id") % 6
    mime = F.element_at(F.array(*[F.lit(m) for m in MIME_BY_RESIDUE]), (r6 + 1).cast("int"))
    has_native = r6.isin(1, 2)
    third = F.floor(F.col("doc_id") / 6) % 3
    native_text = F.when(has_native, F.when(third == 1, F.lit("")).when(third == 2, F.col("text")))
    native_meta = F.when(
        native_text.isNotNull(),
        meta.formatted(
            visible=[("exif-title", "Title", F.concat(F.lit("Doc "), F.col("doc_id").cast("string")))],
            collapsed=[("exif-length", "Length", F.col("n_chars").cast("string")),
                       (meta.STASH_TAG, meta.STASH_TAG, F.lit("hidden"))]))
    return d.select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("/files/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
        mime.alias("mime"),
        has_native.alias("has_native"),
        native_text.alias("native_text"),
        native_meta.alias("native_meta"),
        F.col("text").alias("content"),
        "lang", "source", "n_chars")


def path_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload history: one path per (source, language), many contents each."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("/files/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit(".txt")).alias("path"),
        F.sha1(F.col("text")).alias("sha1"),
        F.col("doc_id").alias("upload_id"))


def file_properties(files_df: DataFrame) -> DataFrame:
    """Extracted metadata per file as an ordered property array (§1.3)."""
    def p(pos, name, *vals, is_list=False):
        return F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("name"),
                        F.array(*vals).alias("values"), F.lit(is_list).alias("is_list"))
    props = F.array(
        p(0, "dc:language", F.col("lang")),
        p(1, "dc:source", F.col("source")),
        p(2, "meta:character-count", F.col("n_chars").cast("string")),
        p(3, "X-TIKA:content", F.col("content")),
        p(4, "meta:keyword", F.lit("dropped")),
        p(5, "Custom:Note", F.lit('a<b & "c"')),
        p(6, "dc:creator", F.concat(F.lit("first "), F.col("source")),
          F.concat(F.lit("second "), F.col("lang")), is_list=True),
        p(7, "geo:lat", F.col("lang")),
    )
    return files_df.withColumn("properties", props)


def as_files(texts: DataFrame, folder: str) -> None:
    """Write every row of ``(name, text)`` as a file ``<folder>/<name>``, overwriting one that is there."""
    def run(frames):
        import os

        import pandas as pd
        from pyarrow import fs

        where, top = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        for f in frames:
            for name, text in zip(f["name"], f["text"]):
                where.create_dir(os.path.dirname(f"{top}/{name}"), recursive=True)
                with where.open_output_stream(f"{top}/{name}") as out:
                    out.write((text or "").encode())
            yield pd.DataFrame({"n": [len(f)]})

    texts.select("name", "text").mapInPandas(run, "n long").agg(F.sum("n")).collect()


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request attempt log from ``lineitem``: HTTP status or transport errno."""
    li = table(spark, sf_dir, "lineitem")
    r9 = F.col("l_partkey") % 9
    status = (F.when(r9 == 0, 200).when(r9 == 1, 204).when(r9 == 2, 422)
              .when(r9 == 3, 500).when(r9 == 4, 503))
    errno = F.when(r9 == 5, 28).when(r9 == 6, 52).when(r9 == 7, 7).when(r9 == 8, 56)
    return li.select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_linenumber").cast("bigint").alias("attempt"),
        status.cast("int").alias("http_status"),
        errno.cast("int").alias("transport_errno"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome log per content hash from ``events`` (A2 input)."""
    return outcomes_from(table(spark, sf_dir, "events"))


def outcomes_from(ev: DataFrame) -> DataFrame:
    """:func:`outcomes` over any frame with the ``events`` columns (batch or stream)."""
    et = F.col("event_type")
    return ev.select(
        "event_id",
        F.sha1(F.col("user_id").cast("string")).alias("sha1"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(et.isin("click", "signup"), "metadata").otherwise("full").alias("request_kind"),
        F.when(et.isin("view", "click"), "success")
         .when(et.isin("error", "signup"), "parser_failure")
         .otherwise("service_failure").alias("outcome"))


def arriving(df: DataFrame, by: str, folder: str, batches: int, again: Column | None = None) -> Iterator[str]:
    """Write all rows as ``batches`` batches of files, dealt by a hash of ``by``: so late rows come in every batch. Rows
    where ``again`` holds are delivered a second time, with the next batch. The folder is told each time one has arrived.

    Each task writes the rows of its own part of ``df`` as a file, so no task holds a batch and nothing is shuffled."""
    at = F.pmod(F.xxhash64(by), F.lit(batches)).cast("int")
    for i in range(batches):
        rows = df.where(at == i)
        if again is not None:
            rows = rows.unionByName(df.where(again & (at == (i - 1) % batches)))
        rows.write.parquet(f"{folder}/arrival={i}")
        yield folder


def store_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes already in the store: an earlier ingest of English documents."""
    d = table(spark, sf_dir, "documents")
    return d.where(F.col("lang") == "en").select(F.sha1("text").alias("sha1")).distinct()


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw extractor answers built from documents: list, duplicate key, number,
    boolean, null, whole text. Every document has its answer; each one under
    100 characters has a second, malformed answer (negative id)."""
    d = table(spark, sf_dir, "documents")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))  # noqa: E731 (values have no quotes)
    text_json = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    body = F.concat(
        F.lit('{"X-TIKA:content":'), text_json,
        F.lit(',"dc:language":'), q(F.col("lang")),
        F.lit(',"dc:creator":['), q(F.col("source")), F.lit(","), q(F.col("lang")), F.lit("]"),
        F.lit(',"meta:character-count":'), F.col("n_chars").cast("string"),
        F.lit(',"dc:source":'), q(F.col("source")),
        F.lit(',"pdf:encrypted":false'),
        F.lit(',"dc:source":'), q(F.col("lang")),
        F.lit(',"Custom:Empty":null}'))
    answers = F.array(F.struct(F.col("doc_id").alias("response_id"), body.alias("body")),
                      F.when(F.col("n_chars") < 100, F.struct((-F.col("doc_id") - 1).alias("response_id"), F.lit("{bad").alias("body"))))
    return d.select(F.explode(F.array_compact(answers)).alias("a")).select("a.*")


def answers_by_digit():
    """A plug-in extractor (one attempt a call) whose answers depend on the first digit of the hash and the attempt.

    0-5 answer at once, 6 and 7 at the second attempt, 8 at the third, 9 is empty at
    the second, a can't be processed at the second, b runs out of time, c at the third,
    d is never answered, e is lost once, f answers with a body that isn't JSON.
    """
    never = (500, None)
    plan = {"6": [(503, None), (200, None)], "7": [(500, None), (200, None)], "8": [(None, 7), (500, None), (200, None)], "9": [(503, None), (204, None)],
            "a": [(500, None), (422, None)], "b": [(None, 28)], "c": [(503, None), (None, 56), (None, 52)], "d": [never] * 99, "e": [None, (200, None)]}

    def ask(frames):
        import json

        import pandas as pd

        for requests in frames:
            rows = []
            for r in requests.itertuples(index=False):
                digit = r.sha1[0]
                answer = plan.get(digit, [(200, None)])[r.attempt - 1]  # asking on after a final answer would be an error here
                if answer is None:
                    continue
                told = {"meta:asked": r.attempt, "dc:language": "x"}
                if r.request_kind == "full":
                    told["X-TIKA:content"] = r.content
                body = ("{" if digit == "f" else json.dumps(told)) if answer[0] == 200 else None
                rows.append((r.sha1, r.request_kind, *answer, body, pd.Timestamp("2024-06-01") + pd.Timedelta(hours=r.attempt)))
            out = pd.DataFrame(rows, columns=["sha1", "request_kind", "http_status", "transport_errno", "response_json", "ts"])
            yield out.astype({"http_status": "Int32", "transport_errno": "Int32"})

    return ask
