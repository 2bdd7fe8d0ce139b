"""The five jobs, each a chain of operators from paths or tables to tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entityhealth import schemas
from entityhealth.operators import (
    aggregates,
    cleanse,
    entities,
    joins,
    model,
    ranks,
    scoring,
    textfeatures,
    upkeep,
)
from entityhealth.rules import DEFAULT_RULES, LEVELS, RuleSet
from entityhealth.session import written
from entityhealth.sources import devicelog, notes, published, sinks, tables

# Food is in grams; the report header keeps its traditional name.
TREND_MEANS = {
    "food_amount": "avg_food_amount_kg",
    "sleep_hours": "avg_sleep_hours",
    "weight_kg": "avg_weight_kg",
}
ATTRIBUTES = ("name", "species", "breed", "gender", "birth_year")


def read_notes(spark: SparkSession, path: str | None) -> DataFrame:
    """Notes, or an empty table where there is no such path."""
    if path is None:
        return spark.createDataFrame([], schemas.NOTE)
    return tables.read_or_empty(spark, lambda: notes.read_note_blocks(spark, path), schemas.NOTE)


def with_profiles(activity: DataFrame, profiles: DataFrame) -> DataFrame:
    """Readings with the profile's name, species and breed instead of their own."""
    own = ("name", "species", "breed")
    return joins.attach_profile(activity, profiles.select("pet_id", *own), "pet_id", "left", replace=own)


def score_readings(
    readings: DataFrame, note_table: DataFrame, rules: RuleSet = DEFAULT_RULES, missing: str = "zero"
) -> DataFrame:
    """Readings with their profile, joined with notes and scored."""
    noted = joins.attach_notes(readings, scoring.annotate_notes(note_table, rules))
    return scoring.score(noted, rules, missing=missing)


class Report(dict[str, str]):
    """Paths of the outputs by name, and in `counts` the rows that the job read, dropped and alerted."""

    def __init__(self, paths: Mapping[str, str], counts: Mapping[str, int]):
        super().__init__(paths)
        self.counts = dict(counts)


def _write_counted(df: DataFrame, path: str, counts: Mapping[str, Column]) -> dict[str, int]:
    """Write the rows and count them on the way.

    The counts stand at the end of the plan, in the tasks that write, so they are
    of the rows written, however often the tasks before them run. An empty table counts 0.
    """
    seen = Observation()
    df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in counts.items()]).write.mode(
        "overwrite"
    ).parquet(path)
    return seen.get


def health_report(
    spark: SparkSession,
    activity_path: str,
    profiles_path: str,
    notes_path: str | None,
    out: str,
    rules: RuleSet = DEFAULT_RULES,
    trees: int = 100,
    missing: str = "zero",
    multi_line: bool = False,
) -> Report:
    """Merge and score all readings; write both tables and the four reports.

    Ids match whatever their case and surrounding blanks. A missing reading
    counts as 0 (`missing='zero'`) or is left out of scores and trends
    (`missing='ignore'`). `multi_line` is for readings with line ends inside
    cells; each input file is then one task.

    The merged and the scored table are written once as Parquet and read back,
    so files are parsed once, the joins run once and a lost executor costs no
    more than its tasks. Trends come from the merged readings, before notes
    repeat them.
    """
    paths = {
        "readings": f"{out}/final_merged_data.parquet",
        "scored": f"{out}/scored.parquet",
        "alerts": f"{out}/pet_health_alerts_final.csv",
        "breed_trends": f"{out}/breed_trends.csv",
        "monthly_trends": f"{out}/monthly_trends.csv",
        "predictions": f"{out}/ml_predictions.csv",
    }
    activity = cleanse.normalize_key(tables.read_activity_csv(spark, activity_path, multi_line=multi_line), "pet_id")
    if missing == "zero":
        activity = cleanse.fill_missing(activity, schemas.METRICS)
    merged = with_profiles(activity, tables.read_profiles(spark, profiles_path))
    ruled = F.col("species").isin([c.category for c in rules.categories])
    counts = _write_counted(
        merged,
        paths["readings"],
        {
            "read": F.count("*"),
            "no_species": F.count_if(F.col("species").isNull()),
            "other_species": F.count_if(~ruled),
            "no_day": F.count_if(F.col("date").isNull()),
        },
    )
    readings = spark.read.parquet(paths["readings"])
    scored = score_readings(readings, read_notes(spark, notes_path), rules, missing)
    counts |= _write_counted(
        scored, paths["scored"], {"scored": F.count("*"), "alerted": F.count_if(F.col("risk_score") > 0)}
    )
    scored = spark.read.parquet(paths["scored"])
    sinks.write_report(scoring.alert_report(scored, schemas.ALERT.fieldNames()), paths["alerts"])

    known = readings.where(ruled)
    sinks.write_report(aggregates.trend_by(known, ["species", "breed"], TREND_MEANS), paths["breed_trends"])
    sinks.write_report(aggregates.trend_by_month(known, "species", "date", TREND_MEANS), paths["monthly_trends"])

    predictions = spark.createDataFrame([], schemas.PREDICTION)
    if counts["scored"]:
        predictions = model.fit_predict(scored, trees=trees)[1].select(*schemas.PREDICTION.fieldNames())
    sinks.write_report(predictions, paths["predictions"])
    return Report(paths, counts)


def read_reports(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The written reports with their declared schemas.

    Alerts hold free texts with line ends, so a part file is one task; the
    scored table lies next to them as Parquet for anything that needs them again.

    Rows without a readable date or prediction are dropped, such as header
    lines repeated where part files were joined by hand.
    """
    alerts = tables.read_report(spark, paths["alerts"], schemas.ALERT, multi_line=True)
    predictions = tables.read_report(spark, paths["predictions"], schemas.PREDICTION)
    return {
        "alerts": alerts.dropna(subset=["date"]),
        "breed_trends": tables.read_report(spark, paths["breed_trends"], schemas.BREED_TREND),
        "monthly_trends": tables.read_report(spark, paths["monthly_trends"], schemas.MONTHLY_TREND),
        "predictions": predictions.dropna(subset=["date", "prediction"]),
    }


def integrate(
    activity: DataFrame,
    profiles: DataFrame,
    log_lines: DataFrame,
    note_table: DataFrame,
    names: Mapping[str, str],
    stop_words: Sequence[str] = textfeatures.STOP_WORDS,
    of_features: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The wide table: readings, profile, age, device sums and text features per entity and day.

    `of_features` names columns that are computed of `text_features` and take its
    place: once for a note, not for each reading that it meets, and vectors are not shuffled.

    Device sums and features are written, since the search for hot keys reads
    both sides of the last join before it runs: the log is parsed and notes are weighed once.
    """
    base = joins.attach_profile(
        cleanse.normalize_key(activity, "pet_id"), cleanse.normalize_key(profiles, "pet_id"), "pet_id", "inner"
    )
    base = cleanse.with_age(base, out="pet_age_at_log")
    daily = devicelog.device_daily_summary(devicelog.parse_device_log(log_lines))
    daily = written(devicelog.mapped_only(devicelog.map_names(daily, names)), "device-days")
    features = textfeatures.tfidf(note_table, stop_words=stop_words, keep=("pet_id", "date"))
    if of_features is not None:
        features = features.select("pet_id", "date", *[c.alias(name) for name, c in of_features.items()])
    features = written(features, "features")
    return joins.attach_text(joins.attach_device(base, daily), features)


def explore(df: DataFrame, limit: float = 2.0) -> dict[str, DataFrame]:
    """Statistics and unusual rows of the wide table."""
    measures = ["food_amount", "sleep_hours"]
    pairs = [(a, b) for b in ("weight_kg", "meow_count") for a in measures]
    out = {
        "describe": aggregates.describe_metrics(df, [*measures, "weight_kg"]),
        "entity_stats": entities.entity_stats(df, measures),
        "anomalies": entities.self_baseline_anomalies(df, measures, limit=limit),
        "loud": cleanse.over_threshold(df, "meow_count", 10),
        "correlations": aggregates.correlations(df, pairs),
        "weekly": aggregates.weekly_summary(
            df,
            {"food_amount": "avg_food_weekly", "sleep_hours": "avg_sleep_weekly", "weight_kg": "avg_weight_weekly"},
        ),
    }
    if "daily_feeder_jams" in df.columns:
        out["jams"] = devicelog.with_jams(df)
    return out


def dashboard_tables(alerts: DataFrame, predictions: DataFrame, activity: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the charts and cards, for all entities at once.

    `activity` carries the species of each reading.
    """
    latest_activity = aggregates.latest_date_rows(activity)
    metrics = ["food_amount", "sleep_hours", "weight_kg"]
    long = cleanse.melt_metrics(latest_activity, ["species"], metrics)
    return {
        "available_ids": entities.available_ids(predictions, alerts, activity),
        "level_distribution": aggregates.latest_level_distribution(alerts, LEVELS),
        "flag_counts": aggregates.latest_flag_counts(
            alerts, {"note_is_stressful": "Stress", "note_is_illness_related": "Bệnh tật"}
        ),
        "alert_trend": model.rule_vs_model(predictions),
        "activity_trend": aggregates.daily_mean(activity, metrics).orderBy("pet_id", "date"),
        "activity_box": ranks.box_stats(long, ["species", "metric"]),
        "activity_card": entities.latest_activity_card(
            activity, schemas.METRICS, places={"food_amount": 2, "sleep_hours": 1, "weight_kg": 2}
        ),
        "alert_card": entities.latest_alert_card(predictions, alerts),
    }


def daily_refresh(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    day: dt.date,
    attributes: Sequence[str] = ATTRIBUTES,
    arrival: Sequence[str] = (),
    entity: str = "pet_id",
    date: str = "date",
) -> None:
    """Bring a table landed by day up to date, rewriting only the days that change.

    Every known entity gets a row for `day` and incoming readings replace what
    was there for their entity and day. A second run changes nothing. The
    table's columns stay: those that `incoming` lacks are NULL in its rows, and
    columns that the table does not have are refused. Rows without a date are a
    day of their own, whose old rows stay like those of any other.

    All changed days are published in one step; `published.read` gives the
    table. A run that fails in between leaves the table as it was.
    """
    now = published.snapshot(spark, path, date)
    existing = published.read(spark, path, date, at=now)
    if unknown := [c for c in incoming.columns if c not in existing.columns]:
        raise ValueError(f"the table has no columns {unknown}")
    incoming = cleanse.conform(incoming, existing.schema)
    carried = written(upkeep.carry_forward(existing, day, attributes, entity, date), "carried")
    days = incoming.select(date).unionByName(carried.select(date)).distinct().withColumnRenamed(date, "_day")
    touched = existing.join(days, existing[date].eqNullSafe(days["_day"]), "left_semi")
    parts = [t.withColumn("_source", F.lit(i)) for i, t in enumerate((touched, carried, incoming))]
    merged = upkeep.dedupe_keep_last(scoring.union_by_name(*parts), [entity, date], ["_source", *arrival])
    published.publish(merged.drop("_source"), path, date, base=now)
