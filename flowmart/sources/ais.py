"""Vessel messages: JSON lines to positions and static records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmart.functions.places import port_region
from flowmart.functions.text import strip_to_null
from flowmart.functions.timez import eta_text, parse_message_time
from flowmart.sources.ids import snapshot_id

# Values are read as text, so a number that comes as text or a whole number that
# comes as a fraction is no error; `_number` gives them their types.
MESSAGE_SCHEMA = """
    MessageType string,
    MetaData struct<MMSI: string, ShipName: string, latitude: string, longitude: string,
                    time_utc: string>,
    Message struct<
        PositionReport: struct<
            Latitude: string, Longitude: string, Sog: string, Cog: string, TrueHeading: string,
            NavigationalStatus: string>,
        ShipStaticData: struct<
            Name: string, Type: string, ImoNumber: string, CallSign: string, Destination: string,
            Dimension: struct<A: string, B: string, C: string, D: string>,
            Eta: map<string, string>, MaximumStaticDraught: string>>,
    _corrupt string
"""

STATIC_ATTRIBUTES = (
    "ship_name",
    "ship_type",
    "imo_number",
    "call_sign",
    "destination",
    "eta_text",
    "dim_a",
    "dim_b",
    "dim_c",
    "dim_d",
    "max_draught",
)


def read_message_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Landed JSON lines with an arrival time and a place in the arrival order."""
    return _with_arrival(spark.read.text(list(paths)))


def stream_message_lines(spark: SparkSession, path: str) -> DataFrame:
    """`read_message_lines` over a folder that keeps receiving files.

    A Kafka source fits as well: `value` cast to string, `timestamp` as
    `received_at`, `offset` as `arrival`.
    """
    return _with_arrival(spark.readStream.text(path))


def _with_arrival(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_modification_time").alias("received_at"),
        F.monotonically_increasing_id().alias("arrival"),
    )


def _number(text: Column, kind: str) -> Column:
    """Text of a JSON number as `kind`; null if it is none, or a fraction where none fits."""
    value = text.try_cast("double")
    if kind == "double":
        return value
    whole = F.when(value == F.floor(value), text.try_cast("decimal(38,9)").try_cast(kind))
    return F.coalesce(text.try_cast(kind), whole)


def _parsed(lines: DataFrame) -> DataFrame:
    """Messages and `reject`: why a line is left out, null if it isn't.

    A line whose JSON cannot be read, or that is no object, is broken; one in
    which some part has another form is kept with that part empty.
    """
    parsed = F.from_json(
        "value", " ".join(MESSAGE_SCHEMA.split()), {"columnNameOfCorruptRecord": "_corrupt"}
    )
    rest = [c for c in lines.columns if c != "value"]
    broken = F.col("_corrupt").isNotNull() & F.json_object_keys("value").isNull()
    mmsi = _number(F.col("MetaData.MMSI"), "bigint")
    return lines.select(*rest, "value", F.inline(F.array(parsed))).withColumn("mmsi", mmsi).withColumn(
        "reject", F.when(broken, "broken").when(F.col("mmsi").isNull(), "no vessel number")
    )


def rejected_messages(lines: DataFrame) -> DataFrame:
    """Lines that `decode_messages` leaves out, counted by `reject`."""
    return _parsed(lines).where(F.col("reject").isNotNull()).groupBy("reject").agg(F.count("*").alias("lines"))


def decode_messages(lines: DataFrame) -> DataFrame:
    """Text to messages; broken JSON and missing vessel numbers drop.

    All other columns of `lines` are kept. The parsed message passes through
    `inline`, which later filters and field reads cannot be pushed below; without
    it the optimizer would parse the text again for each of them.
    """
    rest = [c for c in lines.columns if c != "value"]
    report = "Message.PositionReport"
    # An absent coordinate falls back to the metadata, a null one does not; the
    # keys are looked up in the text for the few reports that lack a value.
    lacks_value = F.col(f"{report}.Latitude").isNull() | F.col(f"{report}.Longitude").isNull()
    keys = F.json_object_keys(F.get_json_object("value", f"$.{report}"))
    return (
        _parsed(lines)
        .where(F.col("reject").isNull())
        .select(
            *rest,
            F.struct("MessageType", "MetaData", "Message").alias("msg"),
            F.when(lacks_value, keys).alias("report_keys"),
            "mmsi",
        )
    )


def _coordinate(key: str) -> Column:
    given = F.coalesce(F.array_contains("report_keys", key), F.lit(False))
    fallback = F.when(~given, F.col(f"msg.MetaData.{key.lower()}"))
    return _number(F.coalesce(F.col(f"msg.Message.PositionReport.{key}"), fallback), "double")


def position_reports(messages: DataFrame) -> DataFrame:
    """Position messages inside a port box, typed and named."""
    body = "msg.Message.PositionReport"
    rest = [c for c in messages.columns if c not in ("msg", "mmsi", "report_keys")]
    # Through `inline` again: the region test then reads values, not their look-up.
    spot = F.struct(
        _coordinate("Latitude").alias("latitude"), _coordinate("Longitude").alias("longitude")
    )
    return (
        messages.where(F.col("msg.MessageType") == "PositionReport")
        .select(*rest, "msg", "mmsi", F.inline(F.array(spot)))
        .withColumn("region", port_region(F.col("latitude"), F.col("longitude")))
        .where(F.col("region").isNotNull())
        .select(
            *rest,
            "region",
            "mmsi",
            strip_to_null(F.col("msg.MetaData.ShipName")).alias("ship_name"),
            "latitude",
            "longitude",
            _number(F.col(f"{body}.Sog"), "double").alias("sog"),
            _number(F.col(f"{body}.Cog"), "double").alias("cog"),
            _number(F.col(f"{body}.TrueHeading"), "int").alias("true_heading"),
            _number(F.col(f"{body}.NavigationalStatus"), "int").alias("navigational_status"),
            parse_message_time(F.col("msg.MetaData.time_utc")).alias("message_ts"),
        )
    )


def static_reports(messages: DataFrame) -> DataFrame:
    """Static messages as vessel attributes."""
    body = "msg.Message.ShipStaticData"
    rest = [c for c in messages.columns if c not in ("msg", "mmsi", "report_keys")]
    return messages.where(F.col("msg.MessageType") == "ShipStaticData").select(
        *rest,
        "mmsi",
        strip_to_null(F.col(f"{body}.Name")).alias("ship_name"),
        _number(F.col(f"{body}.Type"), "int").alias("ship_type"),
        _number(F.col(f"{body}.ImoNumber"), "bigint").alias("imo_number"),
        strip_to_null(F.col(f"{body}.CallSign")).alias("call_sign"),
        strip_to_null(F.col(f"{body}.Destination")).alias("destination"),
        eta_text(F.transform_values(f"{body}.Eta", lambda _, v: _number(v, "int"))).alias("eta_text"),
        *[_number(F.col(f"{body}.Dimension.{side}"), "int").alias(f"dim_{side.lower()}") for side in "ABCD"],
        _number(F.col(f"{body}.MaximumStaticDraught"), "double").alias("max_draught"),
    )


def with_snapshot(df: DataFrame, window: str = "15 minutes", arrival: str = "received_at") -> DataFrame:
    """Add `snapshot_ts`, the start of the arrival window."""
    return df.withColumn("snapshot_ts", F.window(arrival, window)["start"])


def with_snapshot_id(df: DataFrame) -> DataFrame:
    """Add the key of (snapshot, vessel) rows."""
    return df.withColumn("snapshot_id", snapshot_id(F.col("snapshot_ts"), F.col("mmsi")))
