"""Realtime feed snapshots (GTFS-realtime protobuf) as DataFrames.

Landed files are read and written through the ``gtfs_rt`` data source (:mod:`headway.sources.landing`): partitions are
landing hours, and stride sampling happens where the hour's files are listed.  Streams use ``binaryFile`` and
:func:`decode`.  Both decode in the same columnar way; everything after the parse -- timestamps, dates, filters, dedupe
-- is JVM-side.  Only the parse itself is Python (Spark has no built-in protobuf decoder without the optional connector
package).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from headway.functions import ntz_epoch_seconds
from headway.schemas import (
    ACTIVE_PERIODS,
    CARRIAGES,
    INFORMED_ENTITIES,
    MODIFIED_TRIP,
    STOP_TIME_UPDATES,
    TRANSLATED,
    TRIP_PROPERTIES,
)
from headway.session import ship_package
from headway.sources.gtfs_static import file_exists
from headway.sources.landing import FORMAT, MAX_ENTITIES, LandingSource

KINDS = {"vehicle_positions": "vehicle", "alerts": "alert", "trip_updates": "trip_update"}

_HEAD = ("path STRING, header_timestamp BIGINT, gtfs_realtime_version STRING, entity_id STRING, "
         "is_deleted BOOLEAN")
_TRIP = ("trip_id STRING, route_id STRING, direction_id INT, trip_start_time STRING, trip_start_date_text STRING, "
         "trip_schedule_rel STRING")

# Decoded (pre-flattening) row layout per entity kind.
DECODED_DDL = {
    "vehicle": (f"{_HEAD}, {_TRIP}, vehicle_id STRING, vehicle_label STRING, "
                f"multi_carriage_details {CARRIAGES}, latitude DOUBLE, longitude DOUBLE, bearing DOUBLE, "
                "odometer DOUBLE, speed DOUBLE, current_stop_sequence INT, stop_id STRING, current_status STRING, "
                "congestion_level STRING, occupancy_status STRING, occupancy_percentage INT, position_epoch BIGINT"),
    "alert": (f"{_HEAD}, cause STRING, effect STRING, severity_level STRING, active_period {ACTIVE_PERIODS}, "
              f"informed_entity {INFORMED_ENTITIES}, url {TRANSLATED}, header_text {TRANSLATED}, "
              f"description_text {TRANSLATED}, tts_header_text {TRANSLATED}, tts_description_text {TRANSLATED}, "
              f"cause_detail {TRANSLATED}, effect_detail {TRANSLATED}"),
    "trip_update": (f"{_HEAD}, {_TRIP}, modified_trip {MODIFIED_TRIP}, vehicle_id STRING, vehicle_label STRING, "
                    "vehicle_license_plate STRING, wheelchair_accessible STRING, trip_update_epoch BIGINT, delay INT, "
                    f"stop_time_update {STOP_TIME_UPDATES}, trip_properties {TRIP_PROPERTIES}"),
}

# --- Spark side ---------------------------------------------------------------------------------

def read_snapshots(spark: SparkSession, root: str, feed: str, days: list[str] | None = None) -> DataFrame:
    """``(path, content)`` of the landed snapshots of ``feed`` (optionally only some ``dt`` days: their
    folders are the paths that are loaded, so other days are never listed)."""
    base = f"{root.rstrip('/')}/{feed}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb").option("basePath", base)
    if days is None:
        return reader.load(base).select("path", "content")
    there = [p for p in (f"{base}/dt={d}" for d in days) if file_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], "path string, content binary")
    return reader.load(there).select("path", "content")


def landed(spark: SparkSession, root: str, feed: str, days: list[str] | None = None, stride: int = 1) -> DataFrame:
    """Decoded rows of the landed snapshots of ``feed``: of some ``dt`` days, every ``stride``-th poll of each hour."""
    _register(spark)
    reader = spark.read.format(FORMAT).option("feed", feed).option("stride", stride)
    if days is not None:
        reader = reader.option("days", ",".join(days))
    return reader.load(root)


def _register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(LandingSource)


def decode(snapshots: DataFrame, kind: str) -> DataFrame:
    """Decode ``(path, content)`` rows into one row per entity of ``kind``."""
    ship_package(snapshots.sparkSession)
    st = StructType.fromDDL(DECODED_DDL[kind])
    arrow_schema = to_arrow_schema(st)

    def run(batches):
        from headway.sources.gtfs_rt_columns import decode_files

        return decode_files((row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))), kind, arrow_schema)

    return snapshots.select("path", "content").mapInArrow(run, st)


def _path_cols(path: Column) -> list[Column]:
    from headway.plans.raw import path_partitions

    return path_partitions(path)


def poll_of(path) -> Column:
    """The poll a landed file belongs to: its path without the suffix of a part file."""
    return F.regexp_replace(F.col(path) if isinstance(path, str) else path, r"(?:-[cp][0-9]+)+\.pb$", ".pb")


def flatten(decoded: DataFrame, kind: str, tz: str = "America/New_York") -> DataFrame:
    """Decoded rows -> RAW table columns (JVM expressions): partition values from the path,
    epoch seconds to ``tz`` wall clock, ``YYYYMMDD`` start dates to DATE."""
    from headway.functions import epoch_to_local_ntz, yyyymmdd_to_date

    head = [*_path_cols(F.col("path")),
            epoch_to_local_ntz(F.col("header_timestamp"), tz).alias("snapshot_timestamp"),
            F.localtimestamp().alias("ingested_at"), "gtfs_realtime_version", "entity_id", "is_deleted"]
    trip = ["trip_id", "route_id", "direction_id", "trip_start_time",
            yyyymmdd_to_date(F.col("trip_start_date_text")).alias("trip_start_date"), "trip_schedule_rel"]
    if kind == "vehicle":
        rest = ["vehicle_id", "vehicle_label", "multi_carriage_details", "latitude", "longitude", "bearing",
                "odometer", "speed", "current_stop_sequence", "stop_id", "current_status", "congestion_level",
                "occupancy_status", "occupancy_percentage",
                epoch_to_local_ntz(F.col("position_epoch"), tz).alias("position_timestamp")]
        return decoded.select(*head, *trip, *rest)
    if kind == "alert":
        rest = ["cause", "effect", "severity_level", "active_period", "informed_entity", "url", "header_text",
                "description_text", "tts_header_text", "tts_description_text", "cause_detail", "effect_detail"]
        return decoded.select(*head, *rest)
    rest = ["modified_trip", "vehicle_id", "vehicle_label", "vehicle_license_plate", "wheelchair_accessible",
            epoch_to_local_ntz(F.col("trip_update_epoch"), tz).alias("trip_update_timestamp"), "delay",
            "stop_time_update", "trip_properties"]
    return decoded.select(*head, *trip, *rest)


# --- landing ------------------------------------------------------------------------------------

def land(rows: DataFrame, root: str, feed: str, tz: str = "America/New_York", parts_per_snapshot: int = 1,
         max_entities: int = MAX_ENTITIES) -> None:
    """Write RAW-like rows (wall clock in ``tz``) as snapshot files below ``root``: one message per poll, which is
    the second of ``snapshot_timestamp``.  A poll larger than ``max_entities`` becomes several part files, and
    ``parts_per_snapshot > 1`` spreads one poll over that many tasks (hash of the entity id); readers that pick polls
    count the parts of a poll once."""
    from headway.plans.raw import snapshot_path

    def utc_epoch(c: str) -> Column:
        return ntz_epoch_seconds(F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col(c)))

    made = {"path": F.regexp_replace(snapshot_path(feed, "snapshot_timestamp"), "^rt/", ""),
            "header_timestamp": utc_epoch("snapshot_timestamp")}
    if "trip_start_date" in rows.columns:
        made["trip_start_date_text"] = F.date_format("trip_start_date", "yyyyMMdd")
    for epoch, c in (("position_epoch", "position_timestamp"), ("trip_update_epoch", "trip_update_timestamp")):
        if c in rows.columns:
            made[epoch] = utc_epoch(c)
    names = StructType.fromDDL(DECODED_DDL[KINDS[feed]]).names
    df = rows.select(*[(made[c] if c in made else F.col(c)).alias(c) for c in names if c in made or c in rows.columns])
    if parts_per_snapshot > 1:
        part = F.pmod(F.xxhash64("entity_id"), F.lit(parts_per_snapshot))
        df = df.withColumn("path", F.when(part == 0, F.col("path")).otherwise(
            F.regexp_replace("path", r"\.pb$", F.concat(F.lit("-p"), part.cast("string"), F.lit(".pb")))))
    _register(rows.sparkSession)
    (df.repartition("path").sortWithinPartitions("path", "entity_id").write.format(FORMAT).option("feed", feed)
     .option("max_entities", max_entities).mode("append").save(root))
