"""The jobs over whole tables, each against SQL that says what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table
from entityhealth import schemas
from entityhealth.plans import jobs
from entityhealth.session import scratch_path
from entityhealth.sources import published, sinks, tables

# --- daily refresh -------------------------------------------------------------


@query(
    "refresh_job",
    """WITH old AS (
      SELECT event_id, user_id AS entity_id, event_type AS category, value,
        CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) END AS date FROM events
    ), day AS (SELECT max(date) AS d FROM old), carried AS (
      SELECT NULL AS event_id, entity_id, category, NULL AS value, d AS date FROM (
        SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY coalesce(date = d, false) DESC, date DESC NULLS LAST,
          category DESC) AS rn FROM old, day) WHERE rn = 1 AND date IS DISTINCT FROM d
    ), incoming AS (
      SELECT event_id, user_id AS entity_id, event_type AS category, NULL AS value,
        CASE WHEN event_id % 50 <> 0 THEN d END AS date FROM events, day WHERE event_type = 'signup'
    ), days AS (SELECT date FROM incoming UNION SELECT date FROM carried),
    touched AS (SELECT o.* FROM old o WHERE EXISTS (SELECT 1 FROM days x WHERE x.date IS NOT DISTINCT FROM o.date)),
    merged AS (
      SELECT *, 0 AS source FROM touched UNION ALL BY NAME SELECT *, 1 AS source FROM carried
      UNION ALL BY NAME SELECT *, 2 AS source FROM incoming
    ), kept AS (
      SELECT event_id, entity_id, category, value, date FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, date
        ORDER BY source DESC, event_id DESC NULLS LAST, category DESC, value DESC NULLS LAST) AS rn FROM merged) WHERE rn = 1
    )
    SELECT * FROM kept UNION ALL
    SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM days x WHERE x.date IS NOT DISTINCT FROM o.date)""",
)
def refresh_job(spark, sf):
    """Events landed by day, refreshed by rows without a value column, some of them without a day."""
    path = scratch_path(spark, "refresh")
    land_for_refresh(spark, sf, path)
    refresh(spark, sf, path)
    return published.read(spark, path)


def land_for_refresh(spark, sf, path: str) -> None:
    events = table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("entity_id"),
        F.col("event_type").alias("category"),
        "value",
        F.when(F.col("event_id") % 97 != 0, F.col("ts").cast("date")).alias("date"),
    )
    sinks.land(events, path)


def refresh(spark, sf, path: str) -> None:
    day = spark.read.parquet(path).agg(F.max("date")).first()[0]
    signups = table(spark, sf, "events").where("event_type = 'signup'")
    incoming = signups.select(
        "event_id",
        F.col("user_id").alias("entity_id"),
        F.col("event_type").alias("category"),
        F.when(F.col("event_id") % 50 != 0, F.lit(day)).alias("date"),
    )
    jobs.daily_refresh(spark, path, incoming, day, ["category"], ["event_id"], "entity_id")


# --- health report -------------------------------------------------------------

READINGS = """readings AS (
  SELECT 'pet' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS pet_id, CAST(ts AS DATE) AS date,
    CASE WHEN event_id % 11 <> 0 THEN floor(value * 4) ELSE 0 END AS food_amount, floor(value) / 4 AS sleep_hours,
    CAST(event_id % 17 AS INTEGER) AS meow_count, floor(value) / 10 AS weight_kg FROM events
), profiles AS (
  SELECT 'pet' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS pet_id, c_name AS name,
    CASE WHEN c_custkey % 3 = 1 THEN 'cat' ELSE 'dog' END AS species, c_mktsegment AS breed FROM customer
), known AS (
  SELECT r.*, name, species, breed FROM readings r JOIN profiles p ON r.pet_id = p.pet_id
), flagged AS (
  SELECT *, CASE species WHEN 'dog' THEN abs((food_amount - 250) / 50) > 2 ELSE abs((food_amount - 180) / 30) > 2 END AS is_food_anomaly,
    CASE species WHEN 'dog' THEN abs((sleep_hours - 12) / 2) > 2 ELSE abs((sleep_hours - 15) / 3) > 2 END AS is_sleep_anomaly,
    CASE species WHEN 'dog' THEN abs((weight_kg - 15) / 5) > 2 ELSE abs((weight_kg - 4) / 1) > 2 END AS is_weight_anomaly,
    CASE species WHEN 'dog' THEN false ELSE abs((meow_count - 5) / 3) > 2 END AS is_meow_anomaly FROM known
), scored AS (
  SELECT *, CAST(CAST(is_food_anomaly AS INTEGER) + CAST(is_sleep_anomaly AS INTEGER) + 2 * CAST(is_weight_anomaly AS INTEGER)
    + CAST(is_meow_anomaly AS INTEGER) AS INTEGER) AS risk_score FROM flagged
)"""


def _report(spark, sf):
    """What the job wrote, read back."""
    return jobs.read_reports(spark, _run_report(spark, sf))


def _run_report(spark, sf):
    """The job on files: ids in several spellings, missing readings, entities without a profile, no notes."""
    inputs, out = scratch_path(spark, "report-in"), scratch_path(spark, "report-out")
    number = F.lpad(F.col("user_id").cast("string"), 9, "0")
    spelt = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("PET"), number)).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit(" Pet"), number, F.lit(" "))
    )
    activity = table(spark, sf, "events").select(
        F.coalesce(spelt, F.concat(F.lit("pet"), number)).alias("pet_id"),
        F.col("ts").cast("date").alias("date"),
        F.when(F.col("event_id") % 11 != 0, F.floor(F.col("value") * 4)).cast("double").alias("food_amount"),
        (F.floor("value") / 4).alias("sleep_hours"),
        (F.col("event_id") % 17).cast("int").alias("meow_count"),
        (F.floor("value") / 10).alias("weight_kg"),
        F.lit('own, "old" name').alias("name"),
        *[F.lit(None).cast("string").alias(c) for c in ("species", "breed", "gender", "birth_year")],
    )
    profiles = table(spark, sf, "customer").select(
        F.concat(F.lit("PeT"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("pet_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 1, " Cat").otherwise("DOG").alias("species"),
        F.col("c_mktsegment").alias("breed"),
    )
    sinks.write_report(activity, f"{inputs}/activity.csv")
    sinks.write_json(profiles, f"{inputs}/profiles.json")
    return jobs.health_report(
        spark, f"{inputs}/activity.csv", f"{inputs}/profiles.json", f"{inputs}/none.md", out, trees=3
    )


@query(
    "health_report_alerts",
    f"""WITH {READINGS} SELECT pet_id, name, species, breed, date, risk_score,
      CASE WHEN risk_score >= 5 THEN 'Đỏ (Nguy cơ cao)' WHEN risk_score >= 3 THEN 'Cam (Cảnh báo)' ELSE 'Vàng (Theo dõi)' END
        AS health_alert_level, food_amount, is_food_anomaly, sleep_hours, is_sleep_anomaly, weight_kg, is_weight_anomaly,
      meow_count, is_meow_anomaly, CAST(NULL AS VARCHAR) AS note_text, false AS note_is_stressful,
      false AS note_is_illness_related FROM scored WHERE risk_score > 0""",
)
def health_report_alerts(spark, sf):
    """The alert report as the job writes it, read back from its files."""
    return _report(spark, sf)["alerts"]


def _half_up(column: str, out: str) -> str:
    hundredths = f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) * 100 AS HUGEINT)"
    return f"CAST((2 * {hundredths} + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS {out}"


@query(
    "health_report_trends",
    f"""WITH {READINGS} SELECT species, strftime(date, '%Y-%m') AS year_month,
      {", ".join(_half_up(c, out) for c, out in jobs.TREND_MEANS.items())}, count(*) AS total_records
    FROM known GROUP BY ALL""",
)
def health_report_trends(spark, sf):
    """The monthly trends as the job writes them."""
    return _report(spark, sf)["monthly_trends"]


@query(
    "health_report_counts",
    f"""WITH {READINGS}, joined AS (SELECT r.pet_id, date, species FROM readings r LEFT JOIN profiles p ON r.pet_id = p.pet_id),
    outcomes AS (
      SELECT 'read' AS step, count(*) AS n FROM joined UNION ALL
      SELECT 'no_species', count(*) FROM joined WHERE species IS NULL UNION ALL
      SELECT 'other_species', count(*) FROM joined WHERE species NOT IN ('dog', 'cat') UNION ALL
      SELECT 'no_day', count(*) FROM joined WHERE date IS NULL UNION ALL
      SELECT 'scored', count(*) FROM scored UNION ALL
      SELECT 'alerted', count(*) FROM scored WHERE risk_score > 0
    ) SELECT * FROM outcomes""",
)
def health_report_counts(spark, sf):
    """What became of the readings, as counted by the job's own writes."""
    return spark.createDataFrame(list(_run_report(spark, sf).counts.items()), "step string, n bigint")


# --- text in CSV -----------------------------------------------------------------

TEXTS = schemas.struct(doc_id="bigint", lang="string", text="string", source="string")


@query(
    "csv_quoting_roundtrip",
    "SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n_chars, source FROM documents",
)
def csv_quoting_roundtrip(spark, sf):
    """Whole texts with quotes, commas and line ends to CSV and back."""
    path = scratch_path(spark, "texts-csv")
    sinks.write_report(table(spark, sf, "documents").select(*TEXTS.fieldNames()), path)
    back = tables.read_activity_csv(spark, path, TEXTS, multi_line=True)
    return back.select(
        "doc_id", "lang", F.md5("text").alias("text_md5"), F.char_length("text").cast("bigint").alias("n_chars"), "source"
    )
