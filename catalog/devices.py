"""Device logs: parsing, daily sums, names to ids, joins with readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import (
    DAILY, PARSED, PARSED_NAME_OPTIONAL, READINGS_E, log_lines, query, readings_e, table,
)
from entityhealth.operators import joins
from entityhealth.session import scratch_path
from entityhealth.sources import devicelog

EVENT_COLUMNS = """event_id, log_timestamp, log_level, pet_name_from_log, log_message, food_dispensed_g,
  feeder_jammed_event, unusual_behavior_detected"""


@query("device_log_parse", f"WITH {PARSED} SELECT {EVENT_COLUMNS} FROM parsed")
def device_log_parse(spark, sf):
    """Lines without a name do not parse and keep empty fields."""
    return devicelog.parse_device_log(log_lines(spark, sf))


@query("device_log_parse_optional", f"WITH {PARSED_NAME_OPTIONAL} SELECT {EVENT_COLUMNS} FROM parsed")
def device_log_parse_optional(spark, sf):
    """Lines without a name stay as events of the device."""
    return devicelog.parse_device_log(log_lines(spark, sf), entity_optional=True)


@query(
    "device_daily_summary",
    f"""WITH {PARSED}, {DAILY}, names(pet_name_from_log, pet_id) AS (VALUES
      ('Customer#000000001', 'pet001'), ('Customer#000000002', 'pet002'), ('Customer#000000007', 'pet007'))
    SELECT d.*, pet_id FROM daily d JOIN names USING (pet_name_from_log)""",
)
def device_daily_summary(spark, sf):
    """Log lines written to a file, read back, summed by day and mapped to ids by a given table."""
    path = scratch_path(spark, "device-log")
    log_lines(spark, sf).select("value").write.text(path)
    daily = devicelog.device_daily_summary(devicelog.parse_device_log(devicelog.read_log_lines(spark, path)))
    names = {"Customer#000000001": "pet001", "Customer#000000002": "pet002", "Customer#000000007": "pet007"}
    return devicelog.mapped_only(devicelog.map_names(daily, names))


@query("device_jam_days", f"WITH {PARSED}, {DAILY} SELECT * FROM daily WHERE daily_feeder_jams > 0")
def device_jam_days(spark, sf):
    return devicelog.with_jams(devicelog.device_daily_summary(devicelog.parse_device_log(log_lines(spark, sf))))


@query(
    "name_lookup_left",
    f"""WITH {PARSED} SELECT event_id, pet_name_from_log, log_level, c_custkey AS entity_id
    FROM parsed LEFT JOIN customer ON pet_name_from_log = c_name""",
)
def name_lookup_left(spark, sf):
    events = devicelog.parse_device_log(log_lines(spark, sf)).select("event_id", "pet_name_from_log", "log_level")
    profile = table(spark, sf, "customer").withColumnRenamed("c_custkey", "entity_id")
    return joins.lookup_by_name(events, profile, "pet_name_from_log", "c_name", "entity_id")


@query(
    "device_left",
    f"""WITH {PARSED}, {DAILY}, {READINGS_E}, mapped AS (
      SELECT c_custkey AS entity_id, CAST(log_date AS DATE) AS date, daily_food_dispensed_g, daily_feeder_jams,
        daily_unusual_behaviors FROM daily JOIN customer ON pet_name_from_log = c_name)
    SELECT event_id, r.entity_id, r.date, category, value, daily_food_dispensed_g, daily_feeder_jams,
      daily_unusual_behaviors
    FROM readings r LEFT JOIN mapped m ON r.entity_id = m.entity_id AND r.date = m.date""",
)
def device_left(spark, sf):
    """Readings with the device sums of their entity and day."""
    daily = devicelog.device_daily_summary(devicelog.parse_device_log(log_lines(spark, sf)))
    profile = table(spark, sf, "customer").withColumnRenamed("c_custkey", "entity_id")
    named = joins.lookup_by_name(daily, profile, "pet_name_from_log", "c_name", "entity_id")
    mapped = devicelog.mapped_only(named, "entity_id")
    return joins.attach_device(readings_e(spark, sf), mapped, ("entity_id", "date"))
