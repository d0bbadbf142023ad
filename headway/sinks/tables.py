"""Table sinks on plain parquet: tables whose current files a manifest names (no table format needed).

A table is a folder of *file sets* (``set=<id>/<slice>/part-*``), each written by one job and never changed, and of
numbered manifest files (``_MANIFEST-<n>``, JSON).  A slice is a value of the slice columns - a day, a schedule version,
a hash bucket - and the manifest says which set holds it now.  A commit adds one manifest by an exclusive
rename: readers see all slices of a job old or all of them new, a job that is killed before leaves the table as
it was, and of two writers that started from the same manifest one fails.

* :func:`write_table` -- the whole table: every slice it had is gone with the commit.
* :func:`replace_slices` -- the requested slices become equal to a frame (a slice without rows ends up empty).  A slice
  may also name columns that are not slice columns (an hour of a day): the other rows of its day are carried over.
* :func:`upsert_table` -- guarded latest-wins upsert into hash buckets of the key: rows that change nothing are left
  out first, and only buckets with a changed row are written anew.
* :func:`read_table` -- the current rows; partition pruning works as on any partitioned folder, and only current
  files are listed.

Within a set rows are rebalanced by the slice columns (adaptive execution splits a hot day and merges small ones; no
sampling pass, so the plan that feeds the write runs once) and sorted within tasks.  Writes go through Spark's
commit protocol (lost executors are safe).  Old sets stay for readers until :func:`remove_old_files`.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from headway.session import scratch_path

MANIFEST = "_MANIFEST"
BUCKETS = 64            # hash buckets of a new upsert table
SET = "set"             # folder level of the file sets
BUCKET = "bucket"


class Manifest(NamedTuple):
    number: int
    slices: dict[str, str]      # slice folder (``day=2024-01-10``) -> file set
    schema: StructType
    buckets: int | None         # of upsert tables

    def paths(self, base: str, only: Callable[[str], bool] | None = None) -> list[str]:
        return [f"{base}/{SET}={s}/{name}" if name else f"{base}/{SET}={s}"
                for name, s in sorted(self.slices.items()) if only is None or only(name)]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _slice_dir(partition_cols: Sequence[str], values: Mapping[str, object]) -> str:
    parts = []
    for c in partition_cols:
        v = values[c]
        if isinstance(v, (_dt.date, _dt.datetime)):
            v = v.isoformat()
        parts.append(f"{c}={v}")
    return "/".join(parts)


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if st.getPath().getName().startswith(prefix)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


# --- manifests --------------------------------------------------------------------------------

def current_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest whose file sets are all complete; None for a path without manifests.
    Manifests of which none is complete are an error: the table is damaged and must not start anew."""
    base = path.rstrip("/")
    names = _names(spark, base, f"{MANIFEST}-")
    for name in reversed(names):
        try:
            m = json.loads(_read_text(spark, f"{base}/{name}"))
        except ValueError:
            continue
        if all(path_exists(spark, f"{base}/{SET}={x}/_SUCCESS") for x in set(m["slices"].values())):
            return Manifest(int(name.rsplit("-", 1)[1]), m["slices"], StructType.fromJson(m["schema"]), m["buckets"])
    if names:
        raise RuntimeError(f"{base}: manifests exist but none is complete; refusing to start anew")
    return None


def _commit(spark: SparkSession, path: str, before: Manifest | None, slices: dict[str, str], schema: StructType,
            buckets: int | None = None) -> None:
    """Add the manifest after ``before``, renamed into place whole.  A number that another writer took meanwhile
    is an error, and the table keeps that writer's state."""
    base = path.rstrip("/")
    names = _names(spark, base, f"{MANIFEST}-")
    newest = int(names[-1].rsplit("-", 1)[1]) if names else -1
    if newest > (before.number if before is not None else -1):
        now = current_manifest(spark, base)                 # unless those after it are damaged
        if before is None or now is None or now.number != before.number:
            raise RuntimeError(f"{path}: another writer added manifest {newest}; nothing was applied")
    _add_record(spark, path, MANIFEST, newest + 1, {"slices": slices, "schema": schema.jsonValue(), "buckets": buckets})


def _add_record(spark: SparkSession, path: str, prefix: str, number: int, record: dict) -> None:
    """Add the numbered file of a JSON record: renamed into place whole, an error if the number is taken."""
    base = path.rstrip("/")
    fs, made = _fs(spark, f"{base}/.{prefix}.{uuid.uuid4().hex}")
    out = fs.create(made, False)
    try:
        out.write(bytearray(json.dumps(record).encode("utf-8")))
    finally:
        out.close()
    _, final = _fs(spark, f"{base}/{prefix}-{number:012d}")
    if fs.exists(final) or not fs.rename(made, final):
        raise RuntimeError(f"{path}: another writer added {final.getName()}; nothing was applied")


def newest_record(spark: SparkSession, path: str, prefix: str) -> tuple[int, dict] | None:
    """Number and content of the newest record of a kind."""
    names = _names(spark, path.rstrip("/"), f"{prefix}-")
    return (int(names[-1].rsplit("-", 1)[1]), json.loads(_read_text(spark, f"{path.rstrip('/')}/{names[-1]}"))) if names else None


def add_record(spark: SparkSession, path: str, prefix: str, record: dict) -> None:
    last = newest_record(spark, path, prefix)
    _add_record(spark, path, prefix, last[0] + 1 if last else 0, record)


def changed_slices(spark: SparkSession, path: str, since: int | None) -> set[str]:
    """Slices that another file set holds now than under manifest ``since``, or that came or went; all, if there was
    none or it is gone."""
    now = current_manifest(spark, path)
    held = now.slices if now is not None else {}
    old: dict[str, str] = {}
    if since is not None:
        name = f"{path.rstrip('/')}/{MANIFEST}-{since:012d}"
        if path_exists(spark, name):
            old = json.loads(_read_text(spark, name))["slices"]
    return {s for s in {*held, *old} if held.get(s) != old.get(s)}


def _new_set() -> str:
    return f"{_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"


def _slices_of(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Slice folders that a job wrote."""
    fs, p = _fs(spark, folder)
    level = [("", p)]
    for _ in range(depth):
        level = [(f"{name}/{st.getPath().getName()}".lstrip("/"), st.getPath()) for name, q in level for st in fs.listStatus(q)
                 if st.isDirectory() and "=" in st.getPath().getName()]
    return [name for name, _ in level]


def clustered(df: DataFrame, partition_cols: Sequence[str], cluster_cols: Sequence[str] = ()) -> DataFrame:
    """Rebalance by the partition columns and sort within tasks by (partition, cluster) columns."""
    keys = [*partition_cols, *cluster_cols]
    if not keys:
        return df
    spread = df.hint("rebalance", *partition_cols) if partition_cols else df
    return spread.sortWithinPartitions(*keys)


def _write_set(df: DataFrame, path: str, slice_cols: Sequence[str], cluster_cols: Sequence[str]) -> dict[str, str]:
    """Write ``df`` as a new file set; its slices."""
    name = _new_set()
    folder = f"{path.rstrip('/')}/{SET}={name}"
    w = clustered(df, slice_cols, cluster_cols).write.mode("errorifexists")
    (w.partitionBy(*slice_cols) if slice_cols else w).parquet(folder)
    return {s: name for s in _slices_of(df.sparkSession, folder, len(slice_cols))}


# --- readers and writers ------------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, schema=None, only: Callable[[str], bool] | None = None) -> DataFrame:
    """Current rows of a table (``only``: of the slices whose folder name it accepts).  A folder without manifests
    is read as plain partitioned parquet."""
    base = path.rstrip("/")
    m = current_manifest(spark, base)
    if m is None:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.option("basePath", base).parquet(base)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema or m.schema
    paths = m.paths(base, only)
    if not paths:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields]).add(SET, StringType())
    if m.buckets:
        full = full.add(BUCKET, IntegerType())
    rows = spark.read.schema(full).option("basePath", base).parquet(*paths)
    return rows.select(*schema.names)


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (), cluster_cols: Sequence[str] = ()) -> None:
    """Write the whole table: what it held before is replaced by one commit."""
    before = current_manifest(df.sparkSession, path)
    _commit(df.sparkSession, path, before, _write_set(df, path, partition_cols, cluster_cols), df.schema)


def replace_slices(df: DataFrame, path: str, partition_cols: Sequence[str],
                   slices: Iterable[Mapping[str, object]], cluster_cols: Sequence[str] = ()) -> None:
    """Make the table's requested slices equal to ``df`` (which must only hold rows of those slices), by one commit.

    A slice names a prefix of the partition columns, and may then name other columns (the hours of a day): of the
    partitions concerned, rows that no such slice names are written again.  Other slices are untouched."""
    spark = df.sparkSession
    before = current_manifest(spark, path)
    slices = [dict(s) for s in slices]
    held = before.slices if before is not None else {}
    whole = [_slice_dir([c for c in partition_cols if c in s], s) for s in slices]
    gone = _within(held, whole)
    carried = _within(gone, [w for w, s in zip(whole, slices) if not set(s) <= set(partition_cols)])
    rows = df
    if carried:
        rest = read_table(spark, path, df.schema, carried.__contains__)
        rows = df.unionByName(_outside(rest, slices))
    new = _write_set(rows, path, partition_cols, cluster_cols)
    _commit(spark, path, before, {k: v for k, v in held.items() if k not in gone} | new, df.schema)


def _within(names: Iterable[str], folders: Iterable[str]) -> set[str]:
    """Slice names that are one of the folders or lie in one."""
    folders = set(folders)
    return {n for n in names if any(p in folders for p in accumulate(n.split("/"), "{}/{}".format))}


def _outside(rows: DataFrame, slices: Sequence[Mapping[str, object]]) -> DataFrame:
    """Rows that none of the slices names: one anti join per set of named columns, however many slices there are."""
    spark = rows.sparkSession
    for names in sorted({tuple(sorted(s)) for s in slices}):
        named = spark.createDataFrame([tuple(str(s[c]) if s[c] is not None else None for c in names)
                                       for s in slices if tuple(sorted(s)) == names],
                                      ", ".join(f"n{i} string" for i in range(len(names))))
        named = named.select(*[F.col(f"n{i}").cast(rows.schema[c].dataType).alias(f"n{i}") for i, c in enumerate(names)])
        same = [rows[c].eqNullSafe(named[f"n{i}"]) for i, c in enumerate(names)]
        rows = rows.join(F.broadcast(named), same, "left_anti")         # the caller's list
    return rows


def replace_days(df: DataFrame, path: str, day_col: str, days: Iterable, cluster_cols: Sequence[str] = ()) -> None:
    """:func:`replace_slices` keyed by one date column."""
    replace_slices(df, path, [day_col], [{day_col: d} for d in days], cluster_cols)


def upsert_table(source: DataFrame, path: str, keys: Sequence[str], ts: str = "snapshot_timestamp",
                 buckets: int = BUCKETS) -> int:
    """Apply ``source`` (one row per key) to the bucketed table at ``path``; returns the number of buckets written.

    As :func:`headway.operators.upsert.upsert_latest`: a key the table lacks is inserted, a row with a newer ``ts``
    replaces the table's, everything else stays.  Of the table, first the keys and times of the buckets that the
    source has rows in are read, then whole rows of the buckets that change."""
    spark = source.sparkSession
    before = current_manifest(spark, path)
    n = before.buckets if before is not None else buckets
    at = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(BUCKET)
    scratch = scratch_path(spark, "upsert-source")
    source.select("*", at).write.parquet(scratch)                       # evaluated once
    changes = spark.read.schema(StructType([*source.schema.fields]).add(BUCKET, IntegerType())).parquet(scratch)
    if before is not None:
        missing = [c for c in source.columns if c not in before.schema.names]
        if missing:
            raise ValueError(f"target lacks columns {missing}")
        known = _bucket_rows(spark, path, before, _distinct_buckets(changes)).select(
            *[F.col(k).alias(f"t__{k}") for k in keys], F.col(ts).alias("t__ts"), F.col(BUCKET).alias("t__bucket"),
            F.lit(True).alias("t__known"))
        same = [changes[BUCKET] == known["t__bucket"], *[changes[k] == known[f"t__{k}"] for k in keys]]
        changes = (changes.join(known, same, "left").where("t__known is null or " + f"`{ts}` > t__ts")
                   .select(*source.columns, BUCKET))
        scratch = scratch_path(spark, "upsert-changes")
        changes.write.parquet(scratch)
        changes = spark.read.schema(changes.schema).parquet(scratch)
    touched = _distinct_buckets(changes)
    if not touched and before is not None:
        return 0
    rows = changes
    if before is not None:
        named = changes.select(BUCKET, *keys)
        kept = _bucket_rows(spark, path, before, touched).join(named, [BUCKET, *keys], "left_anti")
        rows = kept.select(*changes.columns).unionByName(changes)
    new = _write_set(rows, path, [BUCKET], keys)
    _commit(spark, path, before, (before.slices if before is not None else {}) | new, source.schema, n)
    return len(touched)


def _distinct_buckets(rows: DataFrame) -> set[int]:
    """Buckets with rows: at most as many as the table has."""
    return {r[0] for r in rows.select(BUCKET).distinct().collect()}


def _bucket_rows(spark: SparkSession, path: str, m: Manifest, buckets: set[int]) -> DataFrame:
    full = StructType([*m.schema.fields]).add(BUCKET, IntegerType())
    names = {f"{BUCKET}={b}" for b in buckets}
    paths = m.paths(path.rstrip("/"), names.__contains__)
    if not paths:
        return spark.createDataFrame([], full)
    return (spark.read.schema(StructType([*full.fields]).add(SET, StringType())).option("basePath", path.rstrip("/"))
            .parquet(*paths).select(*full.names))


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """Current rows of an upsert table; None if there is none yet."""
    return None if current_manifest(spark, path) is None else read_table(spark, path)


def remove_old_files(spark: SparkSession, path: str, older_than_hours: float = 72.0) -> int:
    """Delete slice folders that no manifest names which was current within the last hours (longer than any reader
    runs), and the manifests before those; returns the number of folders.  Sets made within that time stay: their
    job may not have committed yet."""
    base = path.rstrip("/")
    limit = _dt.datetime.now(_dt.timezone.utc) - _dt.timedelta(hours=older_than_hours)
    newest = current_manifest(spark, base)
    if newest is None:
        return 0
    kept: set[tuple[str, str]] = set()
    gone = 0
    old = False                                             # reached the manifest that was current at the limit
    for name in reversed(_names(spark, base, f"{MANIFEST}-")):
        if old and int(name.rsplit("-", 1)[1]) < newest.number:
            delete_path(spark, f"{base}/{name}")
            continue
        kept |= set(json.loads(_read_text(spark, f"{base}/{name}"))["slices"].items())
        fs, p = _fs(spark, f"{base}/{name}")
        old = fs.getFileStatus(p).getModificationTime() / 1000 < limit.timestamp()
    depth = max((k.count("/") + 1 if k else 0 for k, _ in kept), default=0)
    for folder in _names(spark, base, f"{SET}="):
        name = folder.split("=", 1)[1]
        made = _dt.datetime.strptime(name.split("-")[0], "%Y%m%dT%H%M%S%f").replace(tzinfo=_dt.timezone.utc)
        if made >= limit:
            continue
        if all(s != name for _, s in kept):
            delete_path(spark, f"{base}/{folder}")
            gone += 1
            continue
        for k in _slices_of(spark, f"{base}/{folder}", depth):
            if (k, name) not in kept:
                delete_path(spark, f"{base}/{folder}/{k}")
                gone += 1
    return gone
