"""Schemas of AIS reports as they arrive on a topic.

A topic row has the Kafka shape ``key, value, topic, partition, offset,
timestamp``. The value holds either one report object or a JSON array of
reports (an envelope). Each report is
``{"Message": {<MessageType>: <body>}, "MessageType": ..., "MetaData": {...}}``.

The body is kept as JSON text in ``MAP<STRING,STRING>`` and parsed a second
time with a union body schema: one struct over all types cannot hold the
``PositionAccuracy`` conflict (a boolean in position reports, an object in
data-link messages), so that field is read as text and cast later.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType,
                               LongType, MapType, StringType, StructField,
                               StructType, TimestampType)

# The 21 AIS message type names of the stream provider, in the
# order the provider's configuration lists them.
MESSAGE_TYPES = [
    "BaseStationReport",
    "MultiSlotBinaryMessage",
    "ExtendedClassBPositionReport",
    "SafetyBroadcastMessage",
    "PositionReport",
    "ShipStaticData",
    "StandardClassBPositionReport",
    "StandardSearchAndRescueAircraftReport",
    "StaticDataReport",
    "SingleSlotBinaryMessage",
    "Interrogation",
    "LongRangeAisBroadcastMessage",
    "GnssBroadcastBinaryMessage",
    "DataLinkManagementMessage",
    "AddressedSafetyMessage",
    "AddressedBinaryMessage",
    "CoordinatedUTCInquiry",
    "BinaryAcknowledge",
    "ChannelManagement",
    "AssignedModeCommand",
    "AidsToNavigationReport",
]

# Message types that carry course/speed/turn features.
POSITION_TYPES = [
    "PositionReport",
    "ExtendedClassBPositionReport",
    "StandardClassBPositionReport",
]

SAR_AIRCRAFT_TYPE = "StandardSearchAndRescueAircraftReport"

METADATA = StructType([
    StructField("MMSI", LongType()),
    StructField("MMSI_String", LongType()),
    StructField("ShipName", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("time_utc", StringType()),
])

REPORT = StructType([
    StructField("Message", MapType(StringType(), StringType())),
    StructField("MessageType", StringType()),
    StructField("MetaData", METADATA),
])

# One schema parses form A (single object, wrapped as a 1-element array by
# from_json) and form B (array envelope); malformed text gives NULL.
ENVELOPE = ArrayType(REPORT)

_B = BooleanType()
_I = IntegerType()
_D = DoubleType()
_L = LongType()

# Union of the body fields of the position, class B, data-link and SAR bodies.
BODY = StructType([StructField(n, t) for n, t in [
    ("Altitude", _I),
    ("AssignedMode", _B),
    ("ClassBBand", _B),
    ("ClassBDisplay", _B),
    ("ClassBDsc", _B),
    ("ClassBMsg22", _B),
    ("ClassBUnit", _B),
    ("Cog", _D),
    ("CommunicationState", _I),
    ("CommunicationStateIsItdma", _B),
    ("Latitude", _D),
    ("Longitude", _D),
    ("MessageID", _I),
    ("NavigationalStatus", _I),
    ("PositionAccuracy", StringType()),
    ("Raim", _B),
    ("RateOfTurn", _I),
    ("RepeatIndicator", _I),
    ("Sog", _D),
    ("Spare", _I),
    ("Spare1", _I),
    ("Spare2", _I),
    ("SpecialManoeuvreIndicator", _I),
    ("Timestamp", _I),
    ("TrueHeading", _I),
    ("UserID", _L),
    ("Valid", _B),
]])

# Kafka-shaped topic rows (value as text, arrival time as an instant).
TOPIC_ROW = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])
