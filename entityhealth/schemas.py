"""Declared schemas of the inputs and column contracts of the reports."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(**kinds: str) -> T.StructType:
    """A schema from column names and type names; needs no running session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in kinds.items()])


ACTIVITY = struct(
    pet_id="string",
    date="date",
    food_amount="double",
    sleep_hours="double",
    meow_count="int",
    weight_kg="double",
    name="string",
    species="string",
    breed="string",
    gender="string",
    birth_year="int",
)
# The declared form counts food in grams and has two sensor columns more.
ACTIVITY_DECLARED = struct(
    pet_id="string",
    date="date",
    food_amount="int",
    water_intake="int",
    sleep_hours="double",
    movement_count="int",
    meow_count="int",
    weight_kg="double",
)
PROFILE = struct(pet_id="string", name="string", species="string", breed="string", gender="string", birth_year="int")
NOTE = struct(pet_id="string", date="date", note_text="string")
DEVICE_EVENT = struct(
    log_timestamp="timestamp_ntz",
    log_level="string",
    pet_name_from_log="string",
    log_message="string",
    food_dispensed_g="int",
    feeder_jammed_event="boolean",
    unusual_behavior_detected="boolean",
)
PREDICTION = struct(pet_id="string", date="date", health_alert_level="string", prediction="double", label="double")
BREED_TREND = struct(
    species="string",
    breed="string",
    avg_food_amount_kg="double",
    avg_sleep_hours="double",
    avg_weight_kg="double",
)
MONTHLY_TREND = struct(
    species="string",
    year_month="string",
    avg_food_amount_kg="double",
    avg_sleep_hours="double",
    avg_weight_kg="double",
    total_records="bigint",
)
ALERT = struct(
    pet_id="string",
    name="string",
    species="string",
    breed="string",
    date="date",
    risk_score="int",
    health_alert_level="string",
    food_amount="double",
    is_food_anomaly="boolean",
    sleep_hours="double",
    is_sleep_anomaly="boolean",
    weight_kg="double",
    is_weight_anomaly="boolean",
    meow_count="int",
    is_meow_anomaly="boolean",
    note_text="string",
    note_is_stressful="boolean",
    note_is_illness_related="boolean",
)
MANIFEST = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

METRICS = ("food_amount", "sleep_hours", "meow_count", "weight_kg")
