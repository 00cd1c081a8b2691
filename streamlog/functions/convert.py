"""Scalar rules between rows and messages, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PROPERTIES, PROPERTY_TYPES, SINK_TYPES, validate_sink

#: The largest long, and the millis whose micros still fit one (of either sign).
MAX_LONG = (1 << 63) - 1
MAX_MILLIS = MAX_LONG // 1000
_ROOTS = {"applicationproperties": "application_properties", "messageannotations": "message_annotations", "properties": "properties"}


def coerce_string(value: Column, kind: T.DataType | str) -> Column:
    """Text as is, bytes as base64, anything else as Spark writes it."""
    name = kind if isinstance(kind, str) else kind.simpleString()
    return F.base64(value) if name == "binary" else value.cast("string")


def millis_to_ts(ms: Column) -> Column:
    """Millis to a timestamp; what doesn't fit becomes the last or first there is."""
    fits = ms.between(-MAX_MILLIS, MAX_MILLIS)
    ends = F.when(ms > 0, F.lit(MAX_LONG)).otherwise(F.lit(-MAX_LONG - 1).cast("long"))
    return F.when(fits, F.timestamp_millis(F.when(fits, ms))).when(ms.isNotNull(), F.timestamp_micros(ends))


def millis_to_ts_or_null(ms: Column) -> Column:
    """Millis to a timestamp; zero or less means unset, and what doesn't fit is dropped."""
    fits = (ms > 0) & (ms <= MAX_MILLIS)
    return F.when(fits, F.timestamp_millis(F.when(fits, ms)))


def ts_to_millis(ts: Column) -> Column:
    """Whole millis, cut toward zero (also before 1970)."""
    us = F.unix_micros(ts)
    return F.call_function("div", us, F.lit(1000).cast("long"))


def non_negative(n: Column) -> Column:
    return F.when(n >= 0, n)


def to_body(value: Column, kind: T.DataType | str) -> Column:
    """Bytes as is, other bodies as UTF-8 text."""
    name = kind if isinstance(kind, str) else kind.simpleString()
    return value if name == "binary" else F.encode(value.cast("string"), "UTF-8")


def normalize_map(m: Column) -> Column:
    """An empty map is null; null values stay."""
    return F.when(F.size(m) > 0, m)


def properties_struct(fields: dict[str, Column]) -> Column:
    """All message properties in order, typed nulls for those not given; null if every field is."""
    unknown = set(fields) - set(PROPERTY_TYPES)
    if unknown:
        raise ValueError(f"unknown properties: {sorted(unknown)}")
    typed = [fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in PROPERTY_TYPES.items()]
    return F.when(_any([c.isNotNull() for c in fields.values()]), F.struct(*typed))


def _any(flags: list[Column]) -> Column:
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out


def _path(path: str) -> tuple[str, str]:
    root, dot, name = path.strip().partition(".")
    root, name = root.strip(), name.strip()
    if not dot or not root or not name:
        raise ValueError(f"a path is <root>.<field>, not {path!r}")
    known = _ROOTS.get(root.lower().replace("-", "").replace("_", ""))
    if not known:
        raise ValueError(f"a path starts with one of {sorted(_ROOTS.values())}, not {root!r}")
    if known == "properties":
        plain = {k.replace("_", ""): k for k in PROPERTY_TYPES}
        key = name.lower().replace("-", "").replace("_", "")
        if key not in plain:
            raise ValueError(f"unknown property {name!r}")
        name = plain[key]
    return known, name


def _property_text(name: str) -> Column:
    c = F.col(f"properties.`{name}`")
    kind = PROPERTY_TYPES[name]
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.TimestampType):
        return F.when(F.unix_micros(c) >= 1000, ts_to_millis(c).cast("string"))
    return F.when(c >= 0, c.cast("string")) if isinstance(kind, T.LongType) else c.cast("string")


def value_at_path(path: str) -> Column:
    """``application_properties.key``, ``message_annotations.key`` or ``properties.name`` as text. Map keys are literal; roots and properties go in any case."""
    root, name = _path(path)
    return _property_text(name) if root == "properties" else F.col(root)[name]


def message_view() -> Column:
    """The set properties as a map of texts: bytes in base64, times in millis, absent ones left out."""
    entries = F.create_map(*(x for k in PROPERTY_TYPES for x in (F.lit(k), _property_text(k))))
    return F.map_filter(entries, lambda _, v: v.isNotNull())


def payload_bytes(value: Column) -> Column:
    return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")


def _map_bytes(m: Column) -> Column:
    each = F.transform(F.map_entries(m), lambda e: F.octet_length(e["key"]) + F.coalesce(F.octet_length(e["value"]), F.lit(0)))
    return F.coalesce(F.aggregate(each, F.lit(0), lambda a, b: a + b), F.lit(0))


def wire_bytes() -> Column:
    """Payload and all keys and values in maps and set properties, in UTF-8 bytes; numbers and times as text, raw user ids as bytes."""
    total = payload_bytes(F.col("value")) + _map_bytes(F.col("application_properties")) + _map_bytes(F.col("message_annotations"))
    for name, kind in PROPERTY_TYPES.items():
        text = F.col("properties.user_id") if isinstance(kind, T.BinaryType) else _property_text(name)
        total = total + F.coalesce(F.octet_length(text) + len(name), F.lit(0))
    return total.cast("long")


def to_source_rows(messages: DataFrame) -> DataFrame:
    """Stored messages -> rows of the source schema: empty maps null, ``creation_time`` from the properties, ``routing_key`` from the application properties."""
    maps = {c: normalize_map(F.col(c)) for c in ("application_properties", "message_annotations")}
    return messages.withColumns(maps).withColumns({"creation_time": F.col("properties.creation_time"), "routing_key": F.col("application_properties")["routing_key"]})


def to_messages(rows: DataFrame, *, ignore_unknown: bool = False) -> DataFrame:
    """Rows of the sink schema -> messages ready to append.

    A null value is an error when its row is written. ``creation_time`` overrides the struct's, other properties stay; a ``routing_key`` column replaces the
    application property of exactly that name. Property structs may be partial and in any order.
    """
    names = validate_sink(rows.schema, ignore_unknown=ignore_unknown)
    col = lambda c: F.col(f"`{names[c]}`") if c in names else F.lit(None).cast(SINK_TYPES[c])
    own: dict[str, Column] = {}
    if "properties" in names:
        kind = next(f.dataType for f in rows.schema.fields if f.name == names["properties"])
        own = {f.name.lower(): col("properties").getField(f.name) for f in kind.fields}
    fields = {k: own.get(k, F.lit(None).cast(t)) for k, t in PROPERTY_TYPES.items()}
    fields["creation_time"] = F.coalesce(col("creation_time"), fields["creation_time"])
    present = col("properties").isNotNull() | col("creation_time").isNotNull()
    given = F.coalesce(col("application_properties"), F.create_map().cast(SINK_TYPES["application_properties"]))
    merged = F.when(col("routing_key").isNotNull(), F.map_concat(F.map_filter(given, lambda k, _: k != "routing_key"), F.create_map(F.lit("routing_key"), col("routing_key")))).otherwise(given)
    value = F.when(col("value").isNull(), F.raise_error(F.lit("the value of a message is null")).cast("binary")).otherwise(col("value"))
    return rows.select(
        value.alias("value"), col("publishing_id").alias("publishing_id"), col("stream").alias("stream"), F.when(present, F.struct(*(fields[k].alias(k) for k in PROPERTY_TYPES))).cast(PROPERTIES).alias("properties"),
        normalize_map(merged).alias("application_properties"), normalize_map(col("message_annotations")).alias("message_annotations"),
    )
