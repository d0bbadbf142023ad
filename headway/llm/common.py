"""Shared helpers of the training-data operators: reading, shared scratch tables, word counting."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import ensure_checkpoint_dir, scratch_path, ship_package

# word bytes are everything but ASCII blank and \t \n \v \f \r (bytes.split() splits on exactly these)
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 2000      # rows of an Arrow batch: texts of this many documents are in a Python worker at a time
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder set, package importable on the executors, Arrow batches of whole texts small."""
    ensure_checkpoint_dir(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write to the cluster's shared scratch folder and read back: computed once, lineage cut,
    readable by every executor after any of them is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)


def text_bytes(col: Column | str) -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.encode(F.col(col) if isinstance(col, str) else col, "UTF-8"), F.lit(b""))


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string/binary Arrow array as one uint8 vector and its n + 1 offsets; nulls empty."""
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        width = np.int64
    else:
        width = np.int32
    _, off, data = arr.buffers()
    n = len(arr)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, width)[arr.offset: arr.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def count_words(arr: pa.Array) -> np.ndarray:
    """Number of words of each text, by one vectorised pass over the Arrow buffer."""
    raw, off = buffers(arr)
    if not len(raw):
        return np.zeros(len(off) - 1, np.int64)
    word = ~_BLANK[raw]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    inner = off[:-1][off[:-1] < len(raw)]
    starts[inner] = word[inner]
    total = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def word_counts(docs: DataFrame, keep: list[Column | str], out: str = "size") -> DataFrame:
    """``keep`` columns (any) plus the number of words of ``text`` as a long column."""
    keep_cols = [F.col(c) if isinstance(c, str) else c for c in keep]
    part = docs.select(*keep_cols, F.col("text").alias("__text"))
    schema = part.select(*[F.col(f"`{c}`") for c in part.columns[:-1]]).schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = count_words(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())],
                                             names=[*b.schema.names[:-1], out])

    return part.mapInArrow(run, schema)


def rows_of(docs: DataFrame) -> Column:
    """The whole row as one struct, so that a table's own columns never clash with working names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")


def unpack(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"__row.`{c}`").alias(c) for c in columns])


class WordMemo:
    """Codes of words met so far in a Python worker: ``learn`` turns new words into rows of a table.

    A bounded memo, not a vocabulary: when it is full it starts anew and words are learnt again.
    """

    def __init__(self, learn, limit: int = 700_000):
        self.learn, self.limit = learn, limit
        self.reset()

    def reset(self) -> None:
        self.code: dict[bytes, int] = {}
        self.rows: np.ndarray | None = None
        self.used = 0

    def rows_of(self, words: list[bytes]) -> np.ndarray:
        """The row of every word."""
        at = self.codes(words)
        return self.rows[at] if self.rows is not None else self.learn([])

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Row number of every word, valid until the next call."""
        collects = gc.isenabled()
        gc.disable()                                   # many small objects, no cycles
        try:
            return self._codes(words)
        finally:
            if collects:
                gc.enable()

    def _codes(self, words: list[bytes]) -> np.ndarray:
        if self.used > self.limit:
            self.reset()
        out = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            distinct = list(dict.fromkeys(fresh))
            rows = self.learn(distinct)
            if self.rows is None:
                self.rows = np.zeros((1 << 16, *rows.shape[1:]), rows.dtype)
            while self.used + len(rows) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[self.used: self.used + len(rows)] = rows
            self.code.update(zip(distinct, range(self.used, self.used + len(rows))))
            self.used += len(rows)
            out[new] = np.fromiter(map(self.code.__getitem__, fresh), np.int64, len(fresh))
        return out


_LASTING: list = []


def lasting(memo):
    """A memo that a Python worker keeps from task to task, until other work in it asks for its memory."""
    _LASTING.append(memo)
    return memo


def release_memos() -> None:
    for memo in _LASTING:
        memo.reset()


def sum_blocks(parts: DataFrame) -> DataFrame:
    """``(name, block, counts)`` with equally long little-endian int64 blocks -> their sums per (name,
    block).  Rows are streamed, a task holds one running block per name and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for b in batches:
            for name, block, counts in zip(*(b.column(i).to_pylist() for i in range(3))):
                one = np.frombuffer(counts, "<i8")
                if (name, block) in total:
                    total[name, block] += one
                else:
                    total[name, block] = one.copy()
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()),
                 pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["name", "block", "counts"])

    return parts.repartition("name", "block").mapInArrow(run, "name string, block int, counts binary")
