from __future__ import annotations

import hashlib

import pytest
from headway.llm import stream_dedup
from headway.session import scratch_path
from pyspark.sql import functions as F


def _expected(rows):
    """(doc_id, keep_id, group_size, kept, text_sha256) by plain grouping; of equal rows one is kept."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for text, docs in groups.items():
        docs = sorted(docs, key=lambda d: (d is None, -(d or 0)))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(d, docs[0], len(docs), i == 0, sha) for i, d in enumerate(docs)]
    return sorted(out, key=str)


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


ROWS = [(1, "a"), (5, "a"), (3, "a"), (5, "a"), (2, ""), (7, None), (None, "a"), (None, "b"), (None, "b"), (-4, "ß"),
        (9, "long " * 50_000), (8, "long " * 50_000), (2**60, "x"), (4, "x\x00"), (6, "x\x00")]


@pytest.mark.parametrize("chars", [64, 1, 0])
def test_every_micro_batch_keeps_the_state(spark, chars):
    """Seven files, one per micro-batch; digests of one or no character make every text a hit that differs."""
    path = scratch_path(spark, "exact")
    for i in range(0, len(ROWS), 2):
        spark.createDataFrame(ROWS[i:i + 2], "doc_id long, text string").withColumn("kept", F.lit("x")) \
            .withColumn("digest", F.lit(None).cast("string")).coalesce(1).write.mode("append").parquet(path)
    got = stream_dedup.deduplicate(spark, path, files_per_trigger=1, chars=chars)
    assert _got(got) == _expected(ROWS)


def test_second_run_takes_up_new_files_only(spark):
    path, store = scratch_path(spark, "exact"), scratch_path(spark, "store")

    def run():
        stream_dedup.keep_state(stream_dedup.places(stream_dedup.source(spark, path)), store)
        return stream_dedup.report(stream_dedup.places(spark.read.parquet(path)), store)

    spark.createDataFrame(ROWS[:4], "doc_id long, text string").write.parquet(path)
    assert _got(run()) == _expected(ROWS[:4])
    assert _got(run()) == _expected(ROWS[:4])                       # nothing new: nothing counted twice
    spark.createDataFrame(ROWS[4:], "doc_id long, text string").write.mode("append").parquet(path)
    assert _got(run()) == _expected(ROWS)


def test_units_are_flushed_without_losing_rows(spark):
    path, store = scratch_path(spark, "exact"), scratch_path(spark, "store")
    rows = [(i, f"t{i % 7}") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    stream_dedup.keep_state(stream_dedup.places(stream_dedup.source(spark, path)), store, held_bytes=300)
    assert _got(stream_dedup.report(stream_dedup.places(spark.read.parquet(path)), store)) == _expected(rows)


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    for df in (odd_documents, no_documents):
        path = scratch_path(spark, "exact")
        df.write.parquet(path)
        assert _got(stream_dedup.deduplicate(spark, path)) == _expected([(r.doc_id, r.text) for r in df.collect()])


def test_one_file_instead_of_a_folder(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert _got(stream_dedup.deduplicate(spark, f"{small}/documents.parquet")) == _expected(rows)
