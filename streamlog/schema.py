"""Types of message rows: what a read returns and what a write takes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TEXT, _TIME, _LONG = T.StringType(), T.TimestampType(), T.LongType()
_MAP = T.MapType(_TEXT, _TEXT)

#: The message properties, in order.
PROPERTY_TYPES = {
    "message_id": _TEXT, "user_id": T.BinaryType(), "to": _TEXT, "subject": _TEXT, "reply_to": _TEXT, "correlation_id": _TEXT, "content_type": _TEXT,
    "content_encoding": _TEXT, "absolute_expiry_time": _TIME, "creation_time": _TIME, "group_id": _TEXT, "group_sequence": _LONG, "reply_to_group_id": _TEXT,
}
PROPERTIES = T.StructType([T.StructField(k, v) for k, v in PROPERTY_TYPES.items()])

FIXED = [T.StructField("value", T.BinaryType()), T.StructField("stream", _TEXT, False), T.StructField("offset", _LONG, False), T.StructField("chunk_timestamp", _TIME, False)]
METADATA = [T.StructField("properties", PROPERTIES), T.StructField("application_properties", _MAP), T.StructField("message_annotations", _MAP), T.StructField("creation_time", _TIME), T.StructField("routing_key", _TEXT)]
SOURCE = T.StructType(FIXED + METADATA)

SINK_TYPES = {"value": T.BinaryType(), "publishing_id": _LONG, "stream": _TEXT, "routing_key": _TEXT, "properties": PROPERTIES, "application_properties": _MAP, "message_annotations": _MAP, "creation_time": _TIME}


def project_metadata(log: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The fixed columns and the wanted optional ones, in the schema's order whatever the order asked for. Pruning reaches the scan."""
    wanted = {w.strip().lower() for w in wanted}
    unknown = wanted - {f.name for f in METADATA}
    if unknown:
        raise ValueError(f"unknown metadata fields: {sorted(unknown)}")
    return log.select(*(f"`{f.name}`" for f in FIXED), *(f"`{f.name}`" for f in METADATA if f.name in wanted))


def _same(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()


def validate_sink(schema: T.StructType, *, ignore_unknown: bool = False) -> dict[str, str]:
    """Sink column -> the input's own name for it. Names match in any case, types exactly; a property struct may hold any subset in any order."""
    found: dict[str, str] = {}
    for f in schema.fields:
        name = f.name.lower()
        if name in found:
            raise ValueError(f"column {f.name!r} is given twice")
        if name not in SINK_TYPES:
            if ignore_unknown:
                continue
            raise ValueError(f"unknown column {f.name!r}")
        if name == "properties":
            if not isinstance(f.dataType, T.StructType):
                raise ValueError("properties must be a struct")
            for p in f.dataType.fields:
                if p.name.lower() not in PROPERTY_TYPES or not _same(p.dataType, PROPERTY_TYPES[p.name.lower()]):
                    raise ValueError(f"unknown property or wrong type: {p.name} {p.dataType.simpleString()}")
        elif not _same(f.dataType, SINK_TYPES[name]):
            raise ValueError(f"column {f.name!r} must be {SINK_TYPES[name].simpleString()}, not {f.dataType.simpleString()}")
        found[name] = f.name
    if "value" not in found:
        raise ValueError("the value column is required")
    return found
