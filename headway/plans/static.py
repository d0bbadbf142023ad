"""Static schedule load: one GTFS version folder -> the eight typed DIM tables.

Every table is keyed by ``feed_start_date`` read from ``feed_info.txt`` (the version anchor), kept
lazy as a scalar subquery rather than collected.  A missing optional file yields an empty typed
table.  :func:`load_static_version` writes each table once, replacing only that version's slice
(dynamic partition overwrite on ``feed_start_date``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import hms_to_seconds, yyyymmdd_to_date
from headway.schemas import LAYOUT, conform, empty
from headway.sinks import tables as sinks
from headway.sources.gtfs_static import GTFS_FILES, collection_columns, file_exists, read_gtfs_csv


def _s(name: str) -> Column:
    return F.col(name).cast("string")


def _i(name: str) -> Column:
    return F.trim(F.col(name)).try_cast("int")


def _d(name: str) -> Column:
    return F.trim(F.col(name)).try_cast("double")


def _b(name: str) -> Column:
    """'0'/'1' (and other boolean text) to BOOLEAN, NULL if not a boolean."""
    return F.trim(F.col(name)).try_cast("boolean")


def _with_optional(df: DataFrame, cols) -> DataFrame:
    """Add absent optional columns as NULL text so projections can name them."""
    missing = [c for c in cols if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing]) if missing else df


# GTFS column lists per file, with their target type (s text, i int, d double,
# b boolean, t yyyyMMdd date).
COLUMNS: dict[str, tuple[tuple[str, str], ...]] = {
    "feed_info": (("feed_start_date", "t"), ("feed_end_date", "t"), ("feed_version", "s"),
                  ("feed_publisher_name", "s"), ("feed_publisher_url", "s"), ("feed_lang", "s"),
                  ("feed_contact_email", "s"), ("feed_id", "s")),
    "agency": (("agency_id", "s"), ("agency_name", "s"), ("agency_url", "s"), ("agency_timezone", "s"),
               ("agency_lang", "s"), ("agency_phone", "s"), ("agency_fare_url", "s")),
    "routes": (("route_id", "s"), ("agency_id", "s"), ("route_short_name", "s"), ("route_long_name", "s"),
               ("route_desc", "s"), ("route_type", "i"), ("route_url", "s"), ("route_color", "s"),
               ("route_text_color", "s"), ("route_sort_order", "i"), ("route_fare_class", "s"), ("line_id", "s"),
               ("listed_route", "s"), ("network_id", "s")),
    "stops": (("stop_id", "s"), ("stop_code", "s"), ("stop_name", "s"), ("stop_desc", "s"), ("platform_code", "s"),
              ("platform_name", "s"), ("stop_lat", "d"), ("stop_lon", "d"), ("zone_id", "s"), ("stop_url", "s"),
              ("level_id", "s"), ("location_type", "i"), ("parent_station", "s"), ("wheelchair_boarding", "i"),
              ("stop_address", "s"), ("municipality", "s"), ("on_street", "s"), ("at_street", "s"),
              ("vehicle_type", "i")),
    "trips": (("trip_id", "s"), ("route_id", "s"), ("service_id", "s"), ("trip_headsign", "s"),
              ("trip_short_name", "s"), ("direction_id", "i"), ("block_id", "s"), ("shape_id", "s"),
              ("wheelchair_accessible", "i"), ("bikes_allowed", "i"), ("trip_route_type", "i"),
              ("route_pattern_id", "s")),
    "stop_times": (("trip_id", "s"), ("stop_sequence", "i"), ("stop_id", "s"), ("arrival_time", "s"),
                   ("departure_time", "s"), ("stop_headsign", "s"), ("pickup_type", "i"), ("drop_off_type", "i"),
                   ("timepoint", "i"), ("checkpoint_id", "s"), ("continuous_pickup", "i"),
                   ("continuous_drop_off", "i")),
    "calendar": (("service_id", "s"), ("monday", "b"), ("tuesday", "b"), ("wednesday", "b"), ("thursday", "b"),
                 ("friday", "b"), ("saturday", "b"), ("sunday", "b"), ("start_date", "t"), ("end_date", "t")),
    "calendar_dates": (("service_id", "s"), ("date", "t"), ("exception_type", "i"), ("holiday_name", "s")),
}

TABLE_OF = {f: ("dim_static_versions" if f == "feed_info" else f"dim_{f}") for f in GTFS_FILES}

_CASTS = {"s": _s, "i": _i, "d": _d, "b": _b, "t": lambda c: yyyymmdd_to_date(F.col(c))}


def typed(df: DataFrame, file: str) -> DataFrame:
    cols = COLUMNS[file]
    df = _with_optional(df, [c for c, _ in cols])
    return df.select(*[_CASTS[t](c).alias(c) for c, t in cols])


def build_dims(spark: SparkSession, version_dir: str) -> dict[str, DataFrame]:
    """The eight DIM tables of one version folder, conformed to their table schemas."""
    base = version_dir.rstrip("/")
    ingested = F.current_timestamp().alias("ingested_at")
    feed_info = typed(read_gtfs_csv(spark, f"{base}/feed_info.txt"), "feed_info")
    anchor = feed_info.select(F.min("feed_start_date")).scalar()
    out: dict[str, DataFrame] = {
        "dim_static_versions": conform(feed_info.select("*", *collection_columns(base), ingested),
                                       "dim_static_versions")}
    for f in GTFS_FILES[1:]:
        table = TABLE_OF[f]
        path = f"{base}/{f}.txt"
        if not file_exists(spark, path):
            out[table] = empty(spark, table)
            continue
        df = typed(read_gtfs_csv(spark, path), f).select(anchor.alias("feed_start_date"), "*", ingested)
        if f == "stop_times":
            df = df.select("*", hms_to_seconds("arrival_time").alias("arrival_seconds"),
                           hms_to_seconds("departure_time").alias("departure_seconds"))
        out[table] = conform(df, table)
    return out


def load_static_version(spark: SparkSession, version_dir: str, warehouse: str, parallel_jobs: int = 4) -> dict[str, str]:
    """Write the eight DIM tables of ``version_dir`` under ``warehouse/<table>``; each write
    replaces only that version's ``feed_start_date`` slice.  The tables are independent, so their
    write jobs are submitted concurrently (``parallel_jobs`` driver threads).  Returns table -> path."""
    from concurrent.futures import ThreadPoolExecutor

    dims = build_dims(spark, version_dir)
    paths = {t: f"{warehouse.rstrip('/')}/{t}" for t in dims}

    anchor = dims["dim_static_versions"].agg(F.min("feed_start_date")).first()[0]

    def write(table: str) -> None:
        part, cluster = LAYOUT[table]
        sinks.replace_slices(dims[table], paths[table], part, [{"feed_start_date": anchor}], cluster)

    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        list(pool.map(write, dims))
    return paths


def write_gtfs_csv(df: DataFrame, path: str) -> None:
    """Write a DataFrame as a GTFS text file (a folder of CSV parts with header), booleans as 0/1
    and dates as yyyyMMdd, as a feed publisher would."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f.name)
        if t == "boolean":
            c = c.cast("int")
        elif t == "date":
            c = F.date_format(c, "yyyyMMdd")
        cols.append(c.cast("string").alias(f.name))
    (df.select(*cols).write.mode("overwrite").option("header", "true")
       .option("quote", '"').option("escape", '"').csv(path))


__all__ = ["build_dims", "load_static_version", "write_gtfs_csv", "typed", "COLUMNS"]
