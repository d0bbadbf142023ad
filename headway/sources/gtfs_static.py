"""GTFS static schedule files: version-folder discovery and CSV reading.

Landing contract: ``<root>/v_YYYYMMDD_HHMMSS/`` holds ``feed_info.txt`` and the other ``.txt``
files; the folder name is the collection time, the schedule version key is ``feed_start_date``
from ``feed_info.txt``.  Files are CSV with a header; every column is read as text and cast by
name afterwards (no inference), so column order and optional columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VERSION_DIR = re.compile(r"^v_(\d{8})_(\d{6})$")

# The schedule files read, in load order (feed_info first: it anchors the version).
GTFS_FILES = ("feed_info", "agency", "routes", "stops", "trips", "stop_times", "calendar", "calendar_dates")


_CSV = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"'}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the start of the split they were read from, and their order in it."""
    return spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("block"),
                                        F.monotonically_increasing_id().alias("seq"))


def _odd(line) -> Column:
    """Whether a line holds an odd number of quotes: a quoted field begins or ends in it and goes over a line end."""
    return F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1


def read_gtfs_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-text read of one GTFS file: header, ``"`` quote and escape; empty and ``""`` fields are NULL.

    A file whose quoted fields go over line ends is read in splits, too (:func:`read_broken_lines`)."""
    blocks = _lines(spark, path).groupBy("file", "block").agg(F.count_if(_odd(F.col("value"))).alias("odd")).where("odd > 0")
    # a row per split that holds a broken line, none for ordinary files
    found = [tuple(r) for r in blocks.collect()]
    if not found:
        return spark.read.options(**_CSV).csv(path)
    return read_broken_lines(spark, path, spark.createDataFrame(found, blocks.schema))


def read_broken_lines(spark: SparkSession, path: str, blocks: DataFrame) -> DataFrame:
    """CSV with fields over several lines, read in splits.

    ``blocks`` has the number of lines with an odd number of quotes per split.  The sum over the splits before tells
    whether a split begins inside a quoted field.  Each split then puts its own lines together to records, in one pass; what it
    has of a record that began before it, or goes on behind it, is stitched to its neighbours' pieces."""
    names = spark.read.options(**_CSV).option("multiLine", "true").csv(path).columns
    lines = _lines(spark, path)
    every = lines.select("file", "block").distinct().join(blocks, ["file", "block"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = every.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    ordered = (lines.withColumn("odd", _odd(F.col("value"))).join(inside, ["file", "block"])
               .repartition("file", "block").sortWithinPartitions("file", "block", "seq"))
    pieces = ordered.select("file", "block", "inside", "value", "odd").mapInArrow(
        _records, "file string, block long, part int, text string")
    whole = pieces.where(f"part = {WHOLE}").select("text")
    loose = pieces.where(f"part != {WHOLE}")
    upto = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stitched = (loose.withColumn("record", F.count_if(F.col("part") == TAIL).over(upto)).groupBy("file", "record")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "text"))), lambda x: x["text"]), "\n")
                     .alias("text")).select("text"))
    ddl = ", ".join(f"`{n}` STRING" for n in names)
    options = {k: v for k, v in _CSV.items() if k in ("quote", "escape")}
    return whole.unionAll(stitched).select(F.from_csv("text", ddl, options).alias("r")).select("r.*")


HEAD, WHOLE, TAIL = 0, 1, 2     # a record's end, a record, a record's beginning; a split inside one record is all HEAD


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lines -> records and pieces of records of each split; headers and blank lines go."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("text", pa.string())])
    split, held, part, quoted, first = None, [], WHOLE, False, True
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal held, first
        text = "\n".join(held)
        if kind != TAIL:
            text = text.removesuffix("\r")
        header = kind == WHOLE and first and split[1] == 0
        if not header and (text or kind != WHOLE):
            out.append((*split, kind, text))
        if kind != HEAD and text:
            first = False
        held = []

    for b in batches:
        for file, block, inside, line, odd in zip(*(c.to_pylist() for c in b.columns)):
            if (file, block) != split:
                if held:
                    close(part if part == HEAD else TAIL)
                split, quoted, part, first = (file, block), inside, HEAD if inside else WHOLE, True
            held.append(line)
            quoted ^= odd
            if not quoted:
                close(part)
                part = WHOLE
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if held:
        close(part if part == HEAD else TAIL)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _list_dirs(spark: SparkSession, root: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def file_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def version_dirs(spark: SparkSession, root: str) -> list[str]:
    """Version folder names under ``root`` that match ``v_YYYYMMDD_HHMMSS``, oldest first."""
    return sorted(n for n in _list_dirs(spark, root) if VERSION_DIR.match(n))


def latest_version_dir(spark: SparkSession, root: str) -> str | None:
    """Newest version folder (by name = collection time), or None."""
    names = version_dirs(spark, root)
    return f"{root.rstrip('/')}/{names[-1]}" if names else None


def version_dir_for_date(spark: SparkSession, root: str, yyyymmdd: str) -> str | None:
    """Newest version folder collected on ``yyyymmdd`` (several may exist for one day)."""
    names = [n for n in version_dirs(spark, root) if VERSION_DIR.match(n).group(1) == yyyymmdd]
    return f"{root.rstrip('/')}/{names[-1]}" if names else None


def collection_stamp(version_dir: str) -> tuple[str, str]:
    """(``yyyyMMdd``, ``yyyyMMdd_HHmmss``) parsed from a version folder name."""
    name = version_dir.rstrip("/").rsplit("/", 1)[-1]
    m = VERSION_DIR.match(name)
    if not m:
        raise ValueError(f"not a version folder: {name}")
    return m.group(1), f"{m.group(1)}_{m.group(2)}"


def collection_columns(version_dir: str) -> list:
    """``collection_date`` / ``collected_at`` literals from the folder name."""
    day, stamp = collection_stamp(version_dir)
    return [F.to_date(F.lit(day), "yyyyMMdd").alias("collection_date"),
            F.to_timestamp(F.lit(stamp), "yyyyMMdd_HHmmss").alias("collected_at")]
