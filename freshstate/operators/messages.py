"""Message edges (P1-P4): route raw JSON messages, decode device payloads into
long form, encode devices back to payload JSON, extract the message key.

All JSON work is VARIANT-based (``try_parse_json``, ``try_variant_get``,
``schema_of_variant``) so it runs JVM-side inside whole-stage codegen. The
payload body is a flattened object — ``id`` next to sensor objects of any value
type — which no fixed StructType can hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col

# Route labels.
ROUTE_FLUSH = "flush"
ROUTE_ERROR = "error"
ROUTE_SKIP = "skip"
ROUTE_TELEMETRY = "telemetry"


def _may_be_json(text: Column) -> Column:
    """False only for texts whose ends show that they are no JSON document: a parser
    that fails costs more than one that succeeds."""
    ends = r'(?s)\A(\{.*\}|\[.*\]|".*"|-?[0-9].*|true|false|null)\z'
    return (text.startswith("{") & text.endswith("}")) | F.btrim(text, F.lit(" \t\r\n")).rlike(ends)


def _parsed(messages: DataFrame, raw: str) -> DataFrame:
    """Adds ``_doc``: an array whose first element is the message body; NULL unless the
    body is exactly one JSON document.

    A parse alone ignores what follows the first document. So the body is parsed once,
    as the first element of an array that a marker, made up for this call, ends: it
    comes second only after one whole document.
    """
    marker, text = uuid.uuid4().hex, F.col(raw).cast("string")
    whole = F.when(_may_be_json(text), F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{marker}"]'))))
    alone = F.try_variant_get("_whole", "$[1]", "string") == marker
    return messages.withColumn("_whole", whole).withColumn("_doc", F.when(alone, F.col("_whole"))).drop("_whole")


def with_body(messages: DataFrame, raw: str = "value", name: str = "_v") -> DataFrame:
    """Adds the VARIANT of a message body (string or binary); NULL unless it is exactly one JSON document."""
    return _parsed(messages, raw).withColumn(name, _member("", "variant")).drop("_doc")


def _member(path: str, kind: str) -> Column:
    """What the body holds at ``path``, taken straight from the parsed text: a VARIANT
    that is passed on is written anew at every step. A path that leads nowhere costs
    as much as the parse, so ask for members that are often absent by a struct or map."""
    return F.try_variant_get("_doc", f"$[0]{path}", kind)


_SENSOR = "struct<value:variant,received_at:variant>"
_ENVELOPE = f"struct<_flush:variant,num_of_data:variant,produced_at:variant,data:map<string,{_SENSOR}>>"
_BATCH_ENVELOPE = "struct<num_of_data:variant,produced_at:variant,data:variant>"
_PARSED = ("_doc", "_env", "_id", "_members")


def with_envelope(messages: DataFrame, raw: str = "value") -> DataFrame:
    """Adds ``_doc`` (parsed body), ``_env`` (top-level members, NULL unless the body is
    an object; its ``data`` is a map of the members read as sensors, NULL unless an
    object), ``_id`` (``data.id``) and ``_members`` (those of ``data``, ``id`` too: key,
    and an object's ``value`` and ``received_at``, else NULL), which the route test and
    the output share.

    Chained projections: each piece is computed once per message (the
    optimizer does not collapse projections that would repeat them), and only
    small scalars are ever passed to ``schema_of_variant``.
    """
    b = _parsed(messages, raw).withColumn("_env", _member("", _ENVELOPE))
    return (b.withColumn("_id", F.when(F.map_contains_key(F.col("_env.data"), "id"), _member(".data.id", "variant")))
            .withColumn("_members", F.map_entries(F.col("_env.data"))))


def _void(x: Column) -> Column:
    return F.coalesce(F.is_variant_null(x), F.lit(False))


def _int_or_absent(x: Column) -> Column:
    """A VARIANT member that is absent, JSON null, or a JSON integer."""
    return F.coalesce(F.schema_of_variant(x).isin("VOID", "TINYINT", "SMALLINT", "INT", "BIGINT"), F.lit(True))


def _sensor_ok(e: Column) -> Column:
    """A sensor object's received_at is an integer (or absent) and its value is no
    number beyond a double's range."""
    obj = e["value"]
    number = F.when(F.schema_of_variant(obj["value"]) == "DOUBLE", F.try_variant_get(obj["value"], "$", "double"))
    finite = F.coalesce(F.abs(number) < F.lit(float("inf")), F.lit(True))
    return (e["key"] == "id") | obj.isNull() | (_int_or_absent(obj["received_at"]) & finite)


def _objects_or_void() -> Column:
    """Every sensor is an object or JSON null: the members are read again, as VARIANTs,
    only where one is no object."""
    others = F.map_filter(_member(".data", "map<string,variant>"), lambda k, x: k != "id")
    neither = F.exists(F.map_values(others), lambda x: ~_void(x) & F.try_variant_get(x, "$", "struct<value:variant>").isNull())
    return ~F.exists("_members", lambda e: (e["key"] != "id") & e["value"].isNull()) | ~neither


def flush_col() -> Column:
    """``_flush`` is the JSON boolean ``true`` (the string "true" is not)."""
    f = F.col("_env._flush")
    return F.coalesce((F.schema_of_variant(f) == "BOOLEAN") & F.try_variant_get(f, "$", "boolean"), F.lit(False))


def error_col() -> Column:
    """True when the message cannot be decoded as a single-device payload.

    Rules: the body is an object (or JSON null); ``num_of_data`` and
    ``produced_at`` are integers; ``data`` is an object (an array is a batched
    payload, an error to the merger); ``data.id`` is a string; every other
    member of ``data`` is an object with an integer ``received_at`` (or null).
    """
    env, data = F.col("_env"), _member(".data", "variant")
    return (
        (env.isNull() & ~_void(_member("", "variant")))
        | ~_int_or_absent(env["num_of_data"])
        | ~_int_or_absent(env["produced_at"])
        | ~(env["data"].isNotNull() | data.isNull() | _void(data))
        | ~F.coalesce(F.schema_of_variant("_id").isin("VOID", "STRING"), F.lit(True))
        | ~F.coalesce(F.forall("_members", _sensor_ok) & _objects_or_void(), F.lit(True))
    )


def device_id_col() -> Column:
    """``data.id`` as a string, '' when absent or null."""
    return F.coalesce(F.try_variant_get("_id", "$", "string"), F.lit(""))


def route_col() -> Column:
    """Flush / error / skip / telemetry, tested in that order."""
    return (F.when(F.col("_doc").isNull(), F.lit(ROUTE_ERROR))
            .when(flush_col(), F.lit(ROUTE_FLUSH))
            .when(error_col(), F.lit(ROUTE_ERROR))
            .when(device_id_col() == "", F.lit(ROUTE_SKIP))
            .otherwise(F.lit(ROUTE_TELEMETRY)))


def with_route(messages: DataFrame, raw: str = "value", keep_parsed: bool = False) -> DataFrame:
    """Adds ``route``; with ``keep_parsed`` the columns of ``with_envelope`` stay."""
    out = with_envelope(messages, raw).withColumn("route", route_col())
    return out if keep_parsed else out.drop(*_PARSED)


def decode_payloads(messages: DataFrame, raw: str = "value",
                    keep: tuple[str, ...] = ("seq", "arr"),
                    with_device_rows: bool = False, tap=None, with_flushes: bool = False) -> DataFrame:
    """Telemetry messages -> long form ``(vin, sensor, value, received_at, produced_at)``.

    ``value`` stays VARIANT (any JSON type); a ``null`` sensor decodes to
    ``(null, 0)`` and a missing ``received_at`` to 0. Non-telemetry messages
    are dropped. With ``with_device_rows`` an id-only payload yields one row
    with ``sensor`` NULL, so the device is still created/refreshed downstream.
    ``tap`` is applied to the routed messages (e.g. to count them). With
    ``with_flushes`` a flush message also yields one row, ``flush`` true (a column
    added last) and ``vin`` NULL, so that one parse gives both.
    """
    # The route test sits inside the generator input and the generator is an
    # outer explode filtered on its *output*: a Filter on the route (or the
    # size(...) > 0 filter Spark infers for a plain explode) would be pushed
    # below the projections and re-evaluate the parse and envelope extraction.
    routed = with_route(messages.select(*keep, raw), raw, keep_parsed=True)
    routed = tap(routed) if tap else routed
    entries, vin, flush = F.col("_members"), device_id_col(), ()
    no_sensor = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast(_SENSOR).alias("value")))
    if with_device_rows:  # a telemetry message always has an id
        entries = F.when(F.size("_members") == 1, no_sensor).otherwise(entries)
    made = F.when(F.col("route") == ROUTE_TELEMETRY, entries)
    if with_flushes:
        made, vin, flush = made.when(F.col("route") == ROUTE_FLUSH, no_sensor), F.when(F.col("route") == ROUTE_TELEMETRY, vin), ("flush",)
        routed = routed.withColumn("flush", F.col("route") == ROUTE_FLUSH)
    base = routed.select(
        *keep, vin.alias("vin"),
        F.coalesce(F.try_variant_get(F.col("_env.produced_at"), "$", "bigint"), F.lit(0)).alias("produced_at"),
        made.alias("_m"), *flush)
    exploded = (base.select(*keep, "vin", "produced_at", *flush, F.explode_outer("_m").alias("_e"))
                .where(F.col("_e").isNotNull() & (F.col("_e.key").isNull() | (F.col("_e.key") != "id"))))
    return exploded.select(
        *keep, "vin", F.col("_e.key").alias("sensor"),
        F.col("_e.value.value").alias("value"),
        F.when(F.col("_e.key").isNull(), F.lit(None).cast("long"))
         .otherwise(F.coalesce(F.try_variant_get("_e.value.received_at", "$", "bigint"), F.lit(0))).alias("received_at"),
        "produced_at", *flush,
    )


def data_object(vin: Column, entries: Column) -> Column:
    """Flattened device object as VARIANT: ``id`` plus one member per sensor.

    ``entries`` is an array of ``struct(sensor, value VARIANT, received_at)``.
    VARIANT objects keep members in key order, matching a JSON encoder that
    sorts map keys. ``id`` is omitted when empty. A sensor named ``id`` is left
    out: the member of that name is the device.
    """
    sensor_entries = F.transform(F.filter(entries, lambda e: e["sensor"] != "id"), lambda e: F.struct(
        e["sensor"].alias("k"),
        F.to_variant_object(F.struct(e["value"].alias("value"), e["received_at"].alias("received_at"))).alias("v")))
    id_entry = F.array(F.struct(F.lit("id").alias("k"), vin.cast("variant").alias("v")))
    all_entries = F.when(vin == "", sensor_entries).otherwise(F.concat(id_entry, sensor_entries))
    return F.to_variant_object(F.map_from_entries(all_entries))


def encode_payload(vin: Column, entries: Column, produced_at, num_of_data=1) -> Column:
    """``{"num_of_data":…,"data":{…},"produced_at":…}`` as JSON text."""
    return F.to_json(F.struct(col(num_of_data).alias("num_of_data"),
                              data_object(vin, entries).alias("data"),
                              col(produced_at).alias("produced_at")))


def sensor_entry(value_col: str = "value") -> Column:
    """``struct(sensor, value VARIANT, received_at)`` for ``collect_list``; NULL
    (so skipped) on a device-only row, whose device then encodes with no sensors."""
    return F.when(F.col("sensor").isNotNull(),
                  F.struct(F.col("sensor"), F.col(value_col).cast("variant").alias("value"), F.col("received_at")))


def decode_batched(messages: DataFrame, raw: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Batched payloads (A5) -> long form ``(keep, num_of_data, pos, vin, sensor, value,
    received_at, produced_at)``, ``pos`` the device's place in the message. A
    device without sensors yields one row with ``sensor`` NULL."""
    env = with_body(messages.select(*keep, raw), raw).select(*keep, F.try_variant_get("_v", "$", _BATCH_ENVELOPE).alias("_env"))
    devices = env.select(*keep, F.try_variant_get("_env.num_of_data", "$", "bigint").alias("num_of_data"),
                         F.try_variant_get("_env.produced_at", "$", "bigint").alias("produced_at"),
                         F.posexplode(F.try_variant_get("_env.data", "$", "array<map<string,variant>>")).alias("pos", "_d"))
    entries = F.map_entries(F.map_filter("_d", lambda k, v: k != "id"))
    rows = devices.select(*keep, "num_of_data", "produced_at", "pos",
                          F.try_variant_get(F.element_at("_d", F.lit("id")), "$", "string").alias("vin"),
                          F.explode_outer(entries).alias("_e"))
    metric = F.try_variant_get(F.col("_e.value"), "$", "struct<value:variant,received_at:bigint>")
    return rows.select(*keep, "num_of_data", "pos", "vin", F.col("_e.key").alias("sensor"), metric["value"].alias("value"),
                       metric["received_at"].alias("received_at"), "produced_at")


def encode_devices(long_rows: DataFrame, produced_at, value_col: str = "value") -> DataFrame:
    """P3 over long form: one ``(vin, payload)`` row per device (A4 + encode).
    Rows with ``sensor`` NULL stand for a device without stored sensors."""
    e = sensor_entry(value_col)
    g = long_rows.groupBy("vin").agg(F.collect_list(e).alias("_entries"))
    return g.select("vin", encode_payload(F.col("vin"), F.col("_entries"), produced_at).alias("payload"))


def key_extract(messages: DataFrame, raw: str = "payload") -> DataFrame:
    """Message key = ``data.id``. Only the envelope is checked (an object
    whose ``data`` is an object with a string ``id``); otherwise the key is NULL
    (the message is an error for the key builder)."""
    e = with_envelope(messages, raw)
    ok = F.col("_env.data").isNotNull() & (F.schema_of_variant("_id") == "STRING")
    return e.withColumn("key", F.when(ok, F.try_variant_get("_id", "$", "string"))).drop(*_PARSED)
