"""GTFS-realtime message classes built at import time from the public specification (proto2),
limited to the messages and fields the RAW tables read.  No generated code and no descriptor
file are needed; executors import this module and build the same classes.
"""

from __future__ import annotations

from google.protobuf import descriptor_pb2, descriptor_pool

try:  # protobuf >= 4
    from google.protobuf.message_factory import GetMessageClass as _message_class
except ImportError:  # pragma: no cover
    from google.protobuf import message_factory as _mf

    def _message_class(desc):
        return _mf.MessageFactory().GetPrototype(desc)

_F = descriptor_pb2.FieldDescriptorProto
OPT, REQ, REP = _F.LABEL_OPTIONAL, _F.LABEL_REQUIRED, _F.LABEL_REPEATED
T = {"string": _F.TYPE_STRING, "bool": _F.TYPE_BOOL, "uint32": _F.TYPE_UINT32, "int32": _F.TYPE_INT32,
     "uint64": _F.TYPE_UINT64, "int64": _F.TYPE_INT64, "float": _F.TYPE_FLOAT, "double": _F.TYPE_DOUBLE}

PKG = "transit_realtime"

# Enums of the public GTFS-realtime specification (name, number).
ENUMS = {
    "Incrementality": (("FULL_DATASET", 0), ("DIFFERENTIAL", 1)),
    "ScheduleRelationship": (("SCHEDULED", 0), ("ADDED", 1), ("UNSCHEDULED", 2), ("CANCELED", 3),
                             ("REPLACEMENT", 5), ("DUPLICATED", 6), ("DELETED", 7), ("NEW", 8)),
    "StopTimeScheduleRelationship": (("SCHEDULED", 0), ("SKIPPED", 1), ("NO_DATA", 2), ("UNSCHEDULED", 3)),
    "WheelchairAccessible": (("NO_VALUE", 0), ("UNKNOWN", 1), ("WHEELCHAIR_ACCESSIBLE", 2),
                             ("WHEELCHAIR_INACCESSIBLE", 3)),
    "VehicleStopStatus": (("INCOMING_AT", 0), ("STOPPED_AT", 1), ("IN_TRANSIT_TO", 2)),
    "CongestionLevel": (("UNKNOWN_CONGESTION_LEVEL", 0), ("RUNNING_SMOOTHLY", 1), ("STOP_AND_GO", 2),
                        ("CONGESTION", 3), ("SEVERE_CONGESTION", 4)),
    "OccupancyStatus": (("EMPTY", 0), ("MANY_SEATS_AVAILABLE", 1), ("FEW_SEATS_AVAILABLE", 2),
                        ("STANDING_ROOM_ONLY", 3), ("CRUSHED_STANDING_ROOM_ONLY", 4), ("FULL", 5),
                        ("NOT_ACCEPTING_PASSENGERS", 6), ("NO_DATA_AVAILABLE", 7), ("NOT_BOARDABLE", 8)),
    "Cause": (("UNKNOWN_CAUSE", 1), ("OTHER_CAUSE", 2), ("TECHNICAL_PROBLEM", 3), ("STRIKE", 4),
              ("DEMONSTRATION", 5), ("ACCIDENT", 6), ("HOLIDAY", 7), ("WEATHER", 8), ("MAINTENANCE", 9),
              ("CONSTRUCTION", 10), ("POLICE_ACTIVITY", 11), ("MEDICAL_EMERGENCY", 12)),
    "Effect": (("NO_SERVICE", 1), ("REDUCED_SERVICE", 2), ("SIGNIFICANT_DELAYS", 3), ("DETOUR", 4),
               ("ADDITIONAL_SERVICE", 5), ("MODIFIED_SERVICE", 6), ("OTHER_EFFECT", 7), ("UNKNOWN_EFFECT", 8),
               ("STOP_MOVED", 9), ("NO_EFFECT", 10), ("ACCESSIBILITY_ISSUE", 11)),
    "SeverityLevel": (("UNKNOWN_SEVERITY", 1), ("INFO", 2), ("WARNING", 3), ("SEVERE", 4)),
}

# Messages of the public GTFS-realtime specification:
# (field name, number, label, type) where type is a scalar name, "E:<enum>" or "M:<message>".
MESSAGES = {
    "FeedMessage": (("header", 1, REQ, "M:FeedHeader"), ("entity", 2, REP, "M:FeedEntity")),
    "FeedHeader": (("gtfs_realtime_version", 1, REQ, "string"), ("incrementality", 2, OPT, "E:Incrementality"),
                   ("timestamp", 3, OPT, "uint64"), ("feed_version", 4, OPT, "string")),
    "FeedEntity": (("id", 1, REQ, "string"), ("is_deleted", 2, OPT, "bool"),
                   ("trip_update", 3, OPT, "M:TripUpdate"), ("vehicle", 4, OPT, "M:VehiclePosition"),
                   ("alert", 5, OPT, "M:Alert")),
    "TripUpdate": (("trip", 1, REQ, "M:TripDescriptor"), ("vehicle", 3, OPT, "M:VehicleDescriptor"),
                   ("stop_time_update", 2, REP, "M:StopTimeUpdate"), ("timestamp", 4, OPT, "uint64"),
                   ("delay", 5, OPT, "int32"), ("trip_properties", 6, OPT, "M:TripProperties")),
    "StopTimeEvent": (("delay", 1, OPT, "int32"), ("time", 2, OPT, "int64"), ("uncertainty", 3, OPT, "int32")),
    "StopTimeUpdate": (("stop_sequence", 1, OPT, "uint32"), ("stop_id", 4, OPT, "string"),
                       ("arrival", 2, OPT, "M:StopTimeEvent"), ("departure", 3, OPT, "M:StopTimeEvent"),
                       ("schedule_relationship", 5, OPT, "E:StopTimeScheduleRelationship")),
    "TripProperties": (("trip_id", 1, OPT, "string"), ("start_date", 2, OPT, "string"),
                       ("start_time", 3, OPT, "string"), ("shape_id", 4, OPT, "string")),
    "VehiclePosition": (("trip", 1, OPT, "M:TripDescriptor"), ("vehicle", 8, OPT, "M:VehicleDescriptor"),
                        ("position", 2, OPT, "M:Position"), ("current_stop_sequence", 3, OPT, "uint32"),
                        ("stop_id", 7, OPT, "string"), ("current_status", 4, OPT, "E:VehicleStopStatus"),
                        ("timestamp", 5, OPT, "uint64"), ("congestion_level", 6, OPT, "E:CongestionLevel"),
                        ("occupancy_status", 9, OPT, "E:OccupancyStatus"),
                        ("occupancy_percentage", 10, OPT, "uint32"),
                        ("multi_carriage_details", 11, REP, "M:CarriageDetails")),
    "CarriageDetails": (("id", 1, OPT, "string"), ("label", 2, OPT, "string"),
                        ("occupancy_status", 3, OPT, "E:OccupancyStatus"), ("occupancy_percentage", 4, OPT, "int32"),
                        ("carriage_sequence", 5, OPT, "uint32")),
    "Alert": (("active_period", 1, REP, "M:TimeRange"), ("informed_entity", 5, REP, "M:EntitySelector"),
              ("cause", 6, OPT, "E:Cause"), ("effect", 7, OPT, "E:Effect"), ("url", 8, OPT, "M:TranslatedString"),
              ("header_text", 10, OPT, "M:TranslatedString"), ("description_text", 11, OPT, "M:TranslatedString"),
              ("tts_header_text", 12, OPT, "M:TranslatedString"),
              ("tts_description_text", 13, OPT, "M:TranslatedString"),
              ("severity_level", 14, OPT, "E:SeverityLevel"), ("cause_detail", 17, OPT, "M:TranslatedString"),
              ("effect_detail", 18, OPT, "M:TranslatedString")),
    "TimeRange": (("start", 1, OPT, "uint64"), ("end", 2, OPT, "uint64")),
    "Position": (("latitude", 1, REQ, "float"), ("longitude", 2, REQ, "float"), ("bearing", 3, OPT, "float"),
                 ("odometer", 4, OPT, "double"), ("speed", 5, OPT, "float")),
    "TripDescriptor": (("trip_id", 1, OPT, "string"), ("route_id", 5, OPT, "string"),
                       ("direction_id", 6, OPT, "uint32"), ("start_time", 2, OPT, "string"),
                       ("start_date", 3, OPT, "string"), ("schedule_relationship", 4, OPT, "E:ScheduleRelationship"),
                       ("modified_trip", 7, OPT, "M:ModifiedTripSelector")),
    "ModifiedTripSelector": (("modifications_id", 1, OPT, "string"), ("affected_trip_id", 2, OPT, "string")),
    "VehicleDescriptor": (("id", 1, OPT, "string"), ("label", 2, OPT, "string"), ("license_plate", 3, OPT, "string"),
                          ("wheelchair_accessible", 4, OPT, "E:WheelchairAccessible")),
    "EntitySelector": (("agency_id", 1, OPT, "string"), ("route_id", 2, OPT, "string"),
                       ("route_type", 3, OPT, "int32"), ("trip", 4, OPT, "M:TripDescriptor"),
                       ("stop_id", 5, OPT, "string"), ("direction_id", 6, OPT, "uint32")),
    "TranslatedString": (("translation", 1, REP, "M:Translation"),),
    "Translation": (("text", 1, REQ, "string"), ("language", 2, OPT, "string")),
}


def _build():
    fdp = descriptor_pb2.FileDescriptorProto(name="headway_gtfs_realtime.proto", package=PKG, syntax="proto2")
    for name, values in ENUMS.items():
        e = fdp.enum_type.add(name=name)
        for vname, num in values:
            # enum value names are scoped to the package: prefix to keep them unique
            e.value.add(name=f"{name}_{vname}", number=num)
    for name, fields in MESSAGES.items():
        m = fdp.message_type.add(name=name)
        for fname, num, label, typ in fields:
            f = m.field.add(name=fname, number=num, label=label)
            if typ.startswith("M:"):
                f.type, f.type_name = _F.TYPE_MESSAGE, f".{PKG}.{typ[2:]}"
            elif typ.startswith("E:"):
                f.type, f.type_name = _F.TYPE_ENUM, f".{PKG}.{typ[2:]}"
            else:
                f.type = T[typ]
    pool = descriptor_pool.DescriptorPool()
    fd = pool.Add(fdp)
    fd = pool.FindFileByName(fdp.name)
    return {n: _message_class(fd.message_types_by_name[n]) for n in MESSAGES}


CLASSES = _build()
FeedMessage = CLASSES["FeedMessage"]


_NAME_OF = {enum: {num: name for name, num in reversed(values)} for enum, values in ENUMS.items()}
_NUMBER_OF = {enum: {name: num for name, num in reversed(values)} for enum, values in ENUMS.items()}


def enum_name(enum: str, number: int | None) -> str | None:
    """Specification name of an enum number (e.g. ``STOPPED_AT``)."""
    return _NAME_OF[enum].get(number)


def enum_number(enum: str, name: str | None) -> int | None:
    if name is None:
        return None
    if name not in _NUMBER_OF[enum]:
        raise ValueError(f"{name} is not a {enum}")
    return _NUMBER_OF[enum][name]
