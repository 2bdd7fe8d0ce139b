"""Device log lines: fields, event flags and daily sums."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityhealth.functions.dates import day_text, parse_timestamp

# Line layout and message markers of the feeder log.
LINE = r"\[(INFO|WARN)\] (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - Pet (.*?) (.*)"
LINE_NAME_OPTIONAL = r"\[(INFO|WARN)\] (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (?:Pet (.*?) )?(.*)"
FOOD = r"Food Dispensed: (\d+)g"
JAMMED = "Feeder Jammed"
UNUSUAL = "Unusual behavior detected"
#: The four groups of a line, one per line of text: no group holds a line end.
GROUPS = "$1\n$2\n$3\n$4"


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_device_log(lines: DataFrame, entity_optional: bool = False) -> DataFrame:
    """Typed events from the column `value`; other columns pass through.

    By default a line needs `Pet <name>`; a line without it yields empty text
    and NULL time. `entity_optional` keeps such lines as device-level events
    with an empty name.
    """
    line = LINE_NAME_OPTIONAL if entity_optional else LINE
    # The line is matched once: its groups, joined with a character that ends no group, take the place of all of it.
    # They are always shorter than what they stand for, so a line that does not match is the one that stays as it was.
    grouped = lines.withColumn("_grouped", F.regexp_replace("value", f"(?s:\\A.*?){line}(?s:.*\\z)", GROUPS))
    found = F.when(F.col("_grouped") != F.col("value"), F.split("_grouped", "\n", 4))
    level, time, entity, message = (F.coalesce(F.get("_found", i), F.lit("")) for i in range(4))
    event = {
        "log_timestamp": parse_timestamp(time),
        "log_level": level,
        "pet_name_from_log": entity,
        "log_message": message,
        "food_dispensed_g": F.regexp_substr(F.regexp_substr(message, F.lit(FOOD)), F.lit(r"\d+")).try_cast("int"),
        "feeder_jammed_event": F.contains(message, F.lit(JAMMED)),
        "unusual_behavior_detected": F.contains(message, F.lit(UNUSUAL)),
    }
    other = [c for c in lines.columns if c != "value"]
    return grouped.withColumn("_found", found).select(*other, *[c.alias(name) for name, c in event.items()])


def device_daily_summary(events: DataFrame) -> DataFrame:
    """Sums and event counts by day and name; partial sums before the shuffle."""
    daily = events.groupBy(F.to_date("log_timestamp").alias("log_date"), "pet_name_from_log").agg(
        F.sum("food_dispensed_g").alias("daily_food_dispensed_g"),
        F.count_if("feeder_jammed_event").alias("daily_feeder_jams"),
        F.count_if("unusual_behavior_detected").alias("daily_unusual_behaviors"),
    )
    return daily.withColumn("log_date", day_text(F.col("log_date")))


def map_names(
    df: DataFrame, mapping: Mapping[str, str], name: str = "pet_name_from_log", entity: str = "pet_id"
) -> DataFrame:
    """Entity id from a given name table; an unmapped name gets NULL.

    The mapping is written in the program, so its broadcast is as small as the
    program text.
    """
    schema = f"{name} string, {entity} string"
    table = df.sparkSession.createDataFrame(list(mapping.items()), schema)
    return df.join(F.broadcast(table), name, "left")


def mapped_only(df: DataFrame, entity: str = "pet_id") -> DataFrame:
    return df.where(F.col(entity).isNotNull())


def with_jams(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("daily_feeder_jams") > 0)
