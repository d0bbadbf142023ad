"""Exact deduplication as a stateful stream.

``keep_state`` runs two Structured Streaming queries over what is new in a table's files.  The first folds rows of equal
bytes of a file, within a task, into one unit: SHA-256 of the text, content locator (file and row number of the
first such row), stable identifier of the row that stays (largest doc_id; ties: largest place), number of rows.
A text that a third of all rows share is one unit per task and file.  The second keeps a state per digest
(streaming aggregation on RocksDB: on the executors' disks, committed to the store folder, never expired) that
retains the digest, the row that stays, the number of rows, and the content locator of the unit seen first, which later
units never change.  No text is kept in the state.

A unit whose digest is retained already is a hit; ``check_hits`` compares every hit byte for byte with the text that
the locator names.  A digest whose bytes differ anywhere is split, and its rows are grouped by their texts.

The queries can be stopped and started again on the same store (only new files are read); lost executors are
recovered from the committed state and the offset logs, and no unit counts twice.

Defined results: a null text counts as empty; a null doc_id never wins over another one (a group of
nothing else has a null keep_id); repeated rows are rows of their group of which one stays; an empty table
gives an empty report; other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import prepare, stored, text_bytes
from headway.session import scratch_path

HELD_BYTES = 64 << 20      # distinct bytes that a task folds at a time; more texts open another set of units
TRIGGER_BYTES = 512 << 30  # input of one micro-batch
DIGEST_CHARS = 64          # hex characters of SHA-256 that key the state
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",      # many small stores: no reserved blocks
}
UNIT = "digest string, file string, row long, keep_id long, keep_row long, n long"


def places(df: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the content locator ``file``, ``row`` of a table read from files."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text"),
                     F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _later(a: tuple, b: tuple) -> bool:
    """``a`` wins over ``b``: (doc_id or None, place...), null ids last."""
    return (a[0] is not None, *a[(a[0] is None):]) > (b[0] is not None, *b[(b[0] is None):])


def _units(chars: int, most: int):
    """Rows of equal bytes of a file -> one unit: first row, row that stays, number of rows."""

    def flush(held: dict) -> pa.RecordBatch:
        cols = list(zip(*[(hashlib.sha256(text).hexdigest()[:chars], file, *unit)
                          for (file, text), unit in held.items()]))
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["digest", "file", "row", "keep_id", "keep_row", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        for b in batches:
            for doc, text, file, row in zip(*(c.to_pylist() for c in b.columns)):
                unit = held.get((file, text))
                if unit is None:
                    held[file, text] = [row, doc, row, 1]
                    size += len(text) + 200
                    if size > most:
                        yield flush(held)
                        held, size = {}, 0
                    continue
                unit[0] = min(unit[0], row)
                if _later((doc, row), (unit[1], unit[2])):
                    unit[1], unit[2] = doc, row
                unit[3] += 1
        if held:
            yield flush(held)

    return run


def source(spark: SparkSession, path: str, files_per_trigger: int | None = None,
           trigger_bytes: int = TRIGGER_BYTES) -> DataFrame:
    """A parquet table (a folder or one file) as a stream of its files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", trigger_bytes)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")      # a pattern of this one name: files and folders alike


def _run(frame: DataFrame, sink: str, mode: str, checkpoint: str, **options: str) -> None:
    query = (frame.writeStream.format(sink).outputMode(mode).options(**options)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def keep_state(rows: DataFrame, store: str, chars: int = DIGEST_CHARS, held_bytes: int = HELD_BYTES,
               files_per_trigger: int | None = None) -> None:
    """Run both queries over everything that is there now and return when it is committed.

    ``rows`` is a stream with the columns of ``places``; ``store`` is a folder that all executors share.
    A later call with the same store takes up where this one ended.
    """
    spark = rows.sparkSession
    _run(rows.mapInArrow(_units(chars, held_bytes), UNIT), "parquet", "append", f"{store}/units-log",
         path=f"{store}/units")
    units = spark.readStream.schema(UNIT)
    if files_per_trigger:
        units = units.option("maxFilesPerTrigger", files_per_trigger)
    # the time of a micro-batch is part of its offset log: a batch that is run again sees the same
    seen = units.parquet(f"{store}/units").withColumn("seen", F.current_timestamp())
    state = seen.groupBy("digest").agg(F.min(F.struct("seen", "file", "row")), F.sum("n"),
                                       F.max(F.struct("keep_id", F.col("file").alias("keep_file"), "keep_row")))
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        _run(state, "noop", "update", f"{store}/state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def classes(spark: SparkSession, store: str) -> DataFrame:
    """The retained state: one row per digest with locator, row that stays and number of rows."""
    state = spark.read.format("statestore").load(f"{store}/state")
    first, n, stays = [f"value.`{c}`" for c in state.schema["value"].dataType.names]
    return state.select("key.digest", f"{first}.file", f"{first}.row", f"{stays}.keep_id", f"{stays}.keep_file",
                        f"{stays}.keep_row", F.col(n).alias("n"))


def check_hits(places_: DataFrame, store: str, retained: DataFrame) -> DataFrame:
    """Digests of which some hit differs in its bytes from the text that the locator names."""
    units = places_.sparkSession.read.schema(UNIT).parquet(f"{store}/units").select("digest", "file", "row")
    named = retained.select("digest", F.col("file").alias("first_file"), F.col("row").alias("first_row"))
    hits = units.join(named, "digest").where("file != first_file or row != first_row")
    both = (hits.select("digest", "file", "row")
            .unionByName(hits.select("digest", F.col("first_file").alias("file"), F.col("first_row").alias("row")).distinct()))
    texts = places_.select("file", "row", "text").join(both, ["file", "row"])
    return (texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
            .where("low != high").select("digest"))


def report(places_: DataFrame, store: str, chars: int = DIGEST_CHARS) -> DataFrame:
    """One row per document of the table: the row of its texts that stays, and how many are equal."""
    retained = stored(classes(places_.sparkSession, store), "stream-dedup-classes")
    split = stored(check_hits(places_, store, retained), "stream-dedup-split")
    hashed = places_.withColumn("text_sha256", F.sha2("text", 256))
    hashed = hashed.withColumn("digest", F.substring("text_sha256", 1, chars))
    stays = F.max(F.struct(F.col("doc_id").alias("keep_id"), F.col("file").alias("keep_file"),
                           F.col("row").alias("keep_row")))
    apart = (hashed.join(split, "digest", "left_semi").groupBy("digest", "text")
             .agg(stays.alias("s"), F.count(F.lit(1)).alias("n"))
             .select("digest", F.sha2("text", 256).alias("sha"), "s.*", "n"))
    whole = (retained.join(split, "digest", "left_anti")
             .select("digest", F.lit(None).cast("string").alias("sha"), "keep_id", "keep_file", "keep_row", "n"))
    rows = hashed.select("doc_id", "file", "row", "digest", "text_sha256").alias("d")
    c = whole.unionByName(apart).alias("c")
    on = (F.col("d.digest") == F.col("c.digest")) & F.coalesce(F.col("c.sha") == F.col("d.text_sha256"), F.lit(True))
    return rows.join(c, on).select(
        "d.doc_id", "c.keep_id", F.col("c.n").alias("group_size"),
        ((F.col("d.file") == F.col("c.keep_file")) & (F.col("d.row") == F.col("c.keep_row"))).alias("kept"),
        "d.text_sha256")


def deduplicate(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                chars: int = DIGEST_CHARS) -> DataFrame:
    """State, check and report of the parquet table at ``path``, in a store of its own."""
    prepare(spark)
    store = scratch_path(spark, "stream-dedup")
    keep_state(places(source(spark, path, files_per_trigger)), store, chars, files_per_trigger=files_per_trigger)
    return report(places(spark.read.parquet(path)), store, chars)
