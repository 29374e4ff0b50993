"""Course, speed, turn, manoeuvre, accuracy and track-type features.

Read from the parsed body (``decode.with_body``); Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import POSITION_TYPES, SAR_AIRCRAFT_TYPE

# The "not available" codes of the AIS standard.
COURSE_UNAVAILABLE = 3600
SPEED_UNAVAILABLE = 1023
TURN_UNAVAILABLE = -128
ALTITUDE_UNAVAILABLE = 4095


def course_degrees(cog: Column, scale: float = 10.0) -> Column:
    """P-11: ``Cog / scale`` to 2 dp (half-even); missing -> 3600."""
    return F.coalesce(F.bround(cog / F.lit(scale), 2), F.lit(float(COURSE_UNAVAILABLE)))


def speed_knots(sog: Column, scale: float = 10.0) -> Column:
    """P-12: ``Sog / scale`` to 1 dp (half-even); missing -> 1023."""
    return F.coalesce(F.bround(sog / F.lit(scale), 1), F.lit(float(SPEED_UNAVAILABLE)))


def rate_of_turn(rot: Column) -> Column:
    """P-13: as reported; missing -> -128."""
    return F.coalesce(rot, F.lit(TURN_UNAVAILABLE))


def special_manoeuvre(smi: Column) -> Column:
    """P-14: truthiness of the indicator; missing -> false."""
    return F.coalesce(smi != 0, F.lit(False))


def position_accuracy(text: Column, any_match: bool = False) -> Column:
    """P-16: the body's ``PositionAccuracy`` as a boolean; missing or not a
    boolean (an object in data-link messages) -> false. ``any_match``
    reproduces the notebook, where any present value counts as true."""
    if any_match:
        return text.isNotNull()
    return F.coalesce(text.try_cast("boolean"), F.lit(False))


def calculate_features(df: DataFrame, body: str = "body", scale: float = 10.0) -> DataFrame:
    """P-11..P-15: the four features, only on the three position-report types
    (P-15 gate); other types get NULL."""
    gate = F.col("MessageType").isin(POSITION_TYPES)

    def gated(c: Column) -> Column:
        return F.when(gate, c)

    return df.withColumns({
        "CourseDegrees": gated(course_degrees(F.col(f"{body}.Cog"), scale)),
        "SpeedKnots": gated(speed_knots(F.col(f"{body}.Sog"), scale)),
        "RateOfTurn": gated(rate_of_turn(F.col(f"{body}.RateOfTurn"))),
        "SpecialManoeuvre": gated(special_manoeuvre(F.col(f"{body}.SpecialManoeuvreIndicator"))),
    })


def with_position_accuracy(df: DataFrame, body: str = "body", any_match: bool = False) -> DataFrame:
    """P-16 as a column ``PositionAccuracy``."""
    return df.withColumn("PositionAccuracy",
                         position_accuracy(F.col(f"{body}.PositionAccuracy"), any_match))


def track_type(message_type: Column, altitude: Column) -> Column:
    """P-17: ``air`` for SAR aircraft reporting an altitude above 0 (4095 is
    the not-available code), else ``surface``."""
    air = ((message_type == F.lit(SAR_AIRCRAFT_TYPE)) & (altitude > 0)
           & (altitude != ALTITUDE_UNAVAILABLE))
    return F.when(F.coalesce(air, F.lit(False)), F.lit("air")).otherwise(F.lit("surface"))


def with_track_type(df: DataFrame, body: str = "body") -> DataFrame:
    return df.withColumn("TrackType", track_type(F.col("MessageType"), F.col(f"{body}.Altitude")))
