"""Adapters: shape the driver's generic tables (``events``, ``supplier``, ``nation``) into the
transit tables the plans consume (schedule dimensions, realtime snapshot tables).

Every frame is a lazy plan over the parquet files, so work grows with ``events``, ``customer``, ``orders`` and
``supplier``.  The mapping is a fixture contract shared with the SQL oracle; the values below are
fixed by that contract.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.time import ntz_epoch_seconds

# Schedule version start dates (the first precedes all events).
VERSION_DATES = ("2023-12-15", "2024-01-11", "2024-01-21")

# Number of services, and the calendar's validity.
SERVICES = 4
CALENDAR_START, CALENDAR_END = "2023-12-01", "2024-01-28"

# Calendar exceptions (service_id, date, exception_type: 1 added, 2 removed).
CALENDAR_EXCEPTIONS = (("S3", "2024-01-15", 1), ("S0", "2024-01-15", 2), ("S1", "2024-01-20", 2))

# Occupancy status by k % 8 (index 0 = no status reported).
OCCUPANCY_BY_K8 = (None, "EMPTY", "MANY_SEATS_AVAILABLE", "MANY_SEATS_AVAILABLE",
                   "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY", "CRUSHED_STANDING_ROOM_ONLY", "FULL")


def _explode_versions() -> Column:
    return F.explode(F.array(*[F.lit(d).cast("date") for d in VERSION_DATES]))


def _flag3(c: Column) -> Column:
    """k % 17: 0 -> TRUE, 1 -> NULL, else FALSE (deletion flag pattern)."""
    m = c % 17
    return F.when(m == 0, F.lit(True)).when(m == 1, F.lit(None).cast("boolean")).otherwise(F.lit(False))


def _hms(sec: Column) -> Column:
    return F.format_string("%02d:%02d:00", F.floor(sec / 3600).cast("int"),
                           (F.floor(sec / 60).cast("int") % 60))


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.col("ts")
    day = F.to_date(ts)
    hour = F.hour(ts).cast("int")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("user_id") % 20).alias("trip_no"),
        day.alias("service_date"),
        hour.alias("hour"),
        ntz_epoch_seconds(ts).alias("epoch_s"),
        F.when(hour < 4, F.date_sub(day, 1)).otherwise(day).alias("trip_start_date"),
    )


def static_versions(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(_explode_versions().alias("feed_start_date"))


class TransitData:
    """The transit tables derived from one driver data directory; each table is built on first
    use (plan construction costs py4j round trips, so unused tables are never built)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return event_base(self.spark, self.sf_dir)

    @cached_property
    def dim_static_versions(self) -> DataFrame:
        return static_versions(self.spark)

    @cached_property
    def dim_routes(self) -> DataFrame:
        sk = F.col("s_suppkey")
        return self._read("supplier").select(
            _explode_versions().alias("feed_start_date"),
            F.concat(F.lit("R"), sk.cast("string")).alias("route_id"),
            F.when(sk % 4 == 3, F.concat(F.lit("SL"), sk.cast("string"))).otherwise(sk.cast("string"))
             .alias("route_short_name"),
            F.when(sk % 3 == 2, F.lit(1)).otherwise(F.lit(3)).cast("int").alias("route_type"),
        )

    @cached_property
    def dim_stops(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self._read("nation").select(
            _explode_versions().alias("feed_start_date"),
            F.concat(F.lit("P"), n.cast("string")).alias("stop_id"),
            F.concat(F.lit("Stop "), (n % 20).cast("string")).alias("stop_name"),
            (F.lit(42.0).cast("double") + n.cast("double") / 1000.0).alias("stop_lat"),
            (F.lit(-71.0).cast("double") - n.cast("double") / 1000.0).alias("stop_lon"),
        )

    @cached_property
    def dim_agency(self) -> DataFrame:
        return self._read("region").select(
            _explode_versions().alias("feed_start_date"),
            F.concat(F.lit("A"), F.col("r_regionkey").cast("string")).alias("agency_id"),
            F.col("r_name").alias("agency_name"))

    @cached_property
    def customer_keys(self) -> DataFrame:
        """The keys that trips and stop times are made of, dealt over tasks before they are multiplied: a key file of a few
        MB is one split, and its rows make fifteen stop times each."""
        keys = self._read("customer").select("c_custkey")
        return keys.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    @cached_property
    def dim_trips(self) -> DataFrame:
        n = F.col("c_custkey")
        return self.customer_keys.select(
            _explode_versions().alias("feed_start_date"),
            F.concat(F.lit("T"), n.cast("string")).alias("trip_id"),
            F.concat(F.lit("R"), (n % 10).cast("string")).alias("route_id"),
            F.concat(F.lit("S"), (n % 4).cast("string")).alias("service_id"),
            F.when(n % 3 == 0, F.lit(0)).when(n % 3 == 1, F.lit(1)).cast("int").alias("direction_id"),
        )

    @cached_property
    def dim_stop_times(self) -> DataFrame:
        n = F.col("c_custkey")
        st = (self.customer_keys.select(n.cast("bigint").alias("c_custkey"), _explode_versions().alias("feed_start_date"))
              .select("c_custkey", "feed_start_date", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("s")))
        sec = ((n % 25) * 2700 + F.col("s") * 600
               + F.when(n % 25 == 24, F.lit(86400)).otherwise(F.lit(0))).cast("int")
        return st.select(
            "feed_start_date",
            F.concat(F.lit("T"), n.cast("string")).alias("trip_id"),
            F.col("s").cast("int").alias("stop_sequence"),
            F.concat(F.lit("P"), ((n + F.col("s")) % 25).cast("string")).alias("stop_id"),
            sec.alias("arrival_seconds"),
            _hms(sec).alias("arrival_time"),
            F.when((n == 23) & (F.col("s") == 1), F.lit(None).cast("string")).otherwise(_hms(sec))
             .alias("departure_time"),
        )

    @cached_property
    def dim_calendar(self) -> DataFrame:
        """The services that trips (customers) refer to: S0 runs on weekdays, S1 on weekends, S2 daily, S3 by exception."""
        n = F.col("n")
        services = self._read("customer").select((F.col("c_custkey") % SERVICES).alias("n")).distinct()
        return services.select(
            _explode_versions().alias("feed_start_date"), F.concat(F.lit("S"), n.cast("string")).alias("service_id"),
            *[n.isin(0, 2).alias(d) for d in ("monday", "tuesday", "wednesday", "thursday", "friday")],
            *[n.isin(1, 2).alias(d) for d in ("saturday", "sunday")],
            F.lit(CALENDAR_START).cast("date").alias("start_date"),
            F.lit(CALENDAR_END).cast("date").alias("end_date"),
        )

    @cached_property
    def dim_calendar_dates(self) -> DataFrame:
        """An exception per service and day with orders of its customers (added or removed by the day's parity), and the
        fixed ones."""
        exc = F.array(*[F.struct(F.lit(sid).alias("service_id"), F.lit(d).cast("date").alias("date"),
                                 F.lit(et).cast("int").alias("exception_type"))
                        for sid, d, et in CALENDAR_EXCEPTIONS])
        n, day = F.col("o_custkey") % SERVICES, F.col("o_orderdate").cast("date")
        ordered = self._read("orders").select(n.alias("n"), day.alias("date")).distinct().select(
            F.concat(F.lit("S"), F.col("n").cast("string")).alias("service_id"), "date",
            (F.dayofmonth("date") % 2 + 1).cast("int").alias("exception_type"))
        fixed = self.spark.range(1).select(F.inline(exc))
        return ordered.unionByName(fixed).select(_explode_versions().alias("feed_start_date"), "*")

    @cached_property
    def raw_vehicle_positions(self) -> DataFrame:
        k = F.col("k")
        trip_no = F.col("trip_no")
        step = (trip_no * 2700 + (k % 5 + 1) * 600 + F.floor(F.col("value") * 5).cast("int") - 200)
        occ = None
        for i, status in enumerate(OCCUPANCY_BY_K8):
            lit = F.lit(status).cast("string")
            occ = F.when(k % 8 == i, lit) if occ is None else occ.when(k % 8 == i, lit)
        return self.events.select(
            "service_date", "hour",
            F.col("ts").alias("snapshot_timestamp"),
            F.col("event_id").cast("string").alias("entity_id"),
            _flag3(k).alias("is_deleted"),
            F.concat(F.lit("T"), trip_no.cast("string")).alias("trip_id"),
            F.concat(F.lit("R"), (trip_no % 10).cast("string")).alias("route_id"),
            "trip_start_date",
            (k % 5 + 1).cast("int").alias("current_stop_sequence"),
            F.concat(F.lit("P"), ((trip_no + k % 5 + 1) % 25).cast("string")).alias("stop_id"),
            F.when(F.col("event_type").isin("view", "click"), F.lit("STOPPED_AT"))
             .otherwise(F.lit("IN_TRANSIT_TO")).alias("current_status"),
            F.when(F.col("value") < 80, F.floor(F.col("value")).cast("int")).alias("occupancy_percentage"),
            occ.alias("occupancy_status"),
            F.timestamp_add("SECOND", step, F.col("trip_start_date").cast("timestamp_ntz"))
             .alias("position_timestamp"),
        )

    @cached_property
    def raw_trip_updates(self) -> DataFrame:
        k = F.col("k")
        trip_no = F.col("trip_no")
        added = (F.col("event_type") == "signup") & (k < 10)
        et = F.col("event_type")
        return self.events.select(
            "service_date", "hour",
            F.col("ts").alias("snapshot_timestamp"),
            F.col("ts").alias("ingested_at"),
            F.col("event_id").cast("string").alias("entity_id"),
            _flag3(k).alias("is_deleted"),
            F.when(added, F.concat(F.lit("X"), k.cast("string")))
             .otherwise(F.concat(F.lit("T"), trip_no.cast("string"))).alias("trip_id"),
            F.concat(F.lit("R"), (trip_no % 10).cast("string")).alias("route_id"),
            F.when(trip_no % 3 == 0, F.lit(0)).when(trip_no % 3 == 1, F.lit(1)).cast("int").alias("direction_id"),
            "trip_start_date",
            F.when(et == "error", F.lit("CANCELED")).when(added, F.lit("ADDED"))
             .when(et == "view", F.lit(" ")).when(et == "click", F.lit(None).cast("string"))
             .otherwise(F.lit("SCHEDULED")).alias("trip_schedule_rel"),
        )

    @cached_property
    def alert_snapshots(self) -> DataFrame:
        return alert_snapshots(self.events)


def load(spark: SparkSession, sf_dir: str) -> TransitData:
    return TransitData(spark, sf_dir)


def _text(c: Column) -> Column:
    """GTFS-realtime TranslatedString with one English translation."""
    return F.struct(F.array(F.struct(c.alias("text"), F.lit("en").alias("language"))).alias("translation"))


def alert_snapshots(ev: DataFrame) -> DataFrame:
    """One alert entity per event, in the nested RAW_ALERTS shape (before per-day dedupe).

    ``event_id`` is carried as the snapshot tie-break."""
    k, epoch = F.col("k"), F.col("epoch_s")
    even = (k % 2 == 0)
    period0 = F.struct((epoch - 86400 * (k % 3)).cast("bigint").alias("start"),
                       F.when(k % 4 == 0, F.lit(None).cast("bigint"))
                        .otherwise(epoch + k * 3600).cast("bigint").alias("end"))
    period1 = F.struct((epoch + 864000).cast("bigint").alias("start"),
                       (epoch + 864000 + k * 60).cast("bigint").alias("end"))
    periods = F.filter(F.array(period0, F.when(even, period1)), lambda x: x.isNotNull())

    def informed(route: Column, stop: Column, route_type: Column, direction: int) -> Column:
        return F.struct(F.lit(None).cast("string").alias("agency_id"), route.alias("route_id"),
                        route_type.cast("int").alias("route_type"), stop.alias("stop_id"),
                        F.lit(direction).cast("int").alias("direction_id"))

    ie0 = informed(F.concat(F.lit("R"), (k % 10).cast("string")),
                   F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("P"), (k % 25).cast("string"))),
                   F.lit(3), 0)
    ie1 = informed(F.concat(F.lit("R"), ((k + 1) % 10).cast("string")),
                   F.concat(F.lit("P"), ((k + 3) % 25).cast("string")),
                   F.when(k % 3 == 0, F.lit(1)).otherwise(F.lit(3)), 1)
    informed_entity = F.filter(F.array(ie0, F.when(even, ie1)), lambda x: x.isNotNull())
    et = F.col("event_type")
    null_text = F.lit(None).cast("struct<translation:array<struct<text:string,language:string>>>")
    return ev.select(
        "event_id", "service_date", "hour",
        F.col("ts").alias("snapshot_timestamp"),
        F.col("ts").alias("ingested_at"),
        F.lit("2.0").alias("gtfs_realtime_version"),
        F.concat(F.lit("A"), (F.col("user_id") * 5 + k % 5).cast("string")).alias("entity_id"),
        _flag3(k).alias("is_deleted"),
        F.when(k % 3 == 0, F.lit("WEATHER")).when(k % 3 == 1, F.lit("CONSTRUCTION"))
         .otherwise(F.lit("UNKNOWN_CAUSE")).alias("cause"),
        F.when(k % 2 == 0, F.lit("DETOUR")).otherwise(F.lit("SIGNIFICANT_DELAYS")).alias("effect"),
        F.when(et == "error", F.lit("SEVERE")).when(et == "purchase", F.lit("WARNING"))
         .otherwise(F.lit("INFO")).alias("severity_level"),
        periods.alias("active_period"),
        informed_entity.alias("informed_entity"),
        null_text.alias("url"),
        _text(F.concat(F.lit("Alert "), k.cast("string"))).alias("header_text"),
        _text(F.concat(F.lit("Detail "), et)).alias("description_text"),
        null_text.alias("tts_header_text"),
        null_text.alias("tts_description_text"),
        null_text.alias("cause_detail"),
        F.when(k % 5 == 0, _text(F.lit("Shuttle buses"))).otherwise(null_text).alias("effect_detail"),
    )
