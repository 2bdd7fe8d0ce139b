"""Readers, writers and cleansing."""

from __future__ import annotations


from pyspark.sql import functions as F

from catalog.registry import NOTES_D, READINGS_E, notes_d, query, readings_e, readings_l, table
from entityhealth import schemas
from entityhealth.operators import aggregates, cleanse, joins
from entityhealth.session import scratch_path
from entityhealth.sources import notes, sinks, tables

ORDER_SCHEMA = schemas.struct(
    o_orderkey="bigint",
    o_custkey="bigint",
    o_orderstatus="string",
    o_totalprice="double",
    o_orderdate="date",
)
ORDER_REPORT = schemas.struct(
    o_orderstatus="string",
    orders="bigint",
    customers_seen="bigint",
    total_price="double",
    first_day="date",
    last_day="date",
)


@query(
    "csv_roundtrip_agg",
    """SELECT o_orderstatus, count(*) AS orders, count(o_custkey) AS customers_seen,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price,
       CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
       FROM orders GROUP BY o_orderstatus""",
)
def csv_roundtrip_agg(spark, sf):
    """Orders to CSV and back, a small report of them to one file and back."""
    raw, report, single = (scratch_path(spark, n) for n in ("orders-csv", "report-csv", "report-file"))
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    sinks.write_report(orders.select(*ORDER_SCHEMA.fieldNames()), raw)
    back = tables.read_activity_csv(spark, raw, ORDER_SCHEMA)
    totals = back.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"),
        F.count("o_custkey").alias("customers_seen"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
        F.min("o_orderdate").alias("first_day"),
        F.max("o_orderdate").alias("last_day"),
    )
    sinks.write_report(totals, report)
    sinks.export_single_file(spark, report, single, ORDER_REPORT)
    return tables.read_report(spark, single, ORDER_REPORT)


CUSTOMER = schemas.struct(
    c_custkey="bigint",
    c_name="string",
    c_nationkey="int",
    c_acctbal="double",
    c_mktsegment="string",
)


@query(
    "json_roundtrip_agg",
    """SELECT c_mktsegment, c_nationkey, count(*) AS customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance, max(c_name) AS last_name
       FROM customer GROUP BY c_mktsegment, c_nationkey""",
)
def json_roundtrip_agg(spark, sf):
    path = scratch_path(spark, "customer-json")
    sinks.write_json(table(spark, sf, "customer"), path)
    back = tables.read_json_records(spark, path, CUSTOMER, layout="lines")
    return back.groupBy("c_mktsegment", "c_nationkey").agg(
        F.count("*").alias("customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        F.max("c_name").alias("last_name"),
    )


@query(
    "note_blocks_roundtrip",
    rf"""WITH {NOTES_D}
    SELECT 'pet' || lpad(CAST(entity_id AS VARCHAR), 3, '0') AS pet_id, date,
      CAST(length(body) AS INTEGER) AS note_length, md5(body) AS note_md5
    FROM (SELECT entity_id, date,
                 regexp_replace(note_text, '^[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g') AS body
          FROM notes)""",
)
def note_blocks_roundtrip(spark, sf):
    """Documents to a file of note blocks and back; whole texts compared by digest."""
    path = scratch_path(spark, "notes-md")
    pet = F.concat(F.lit("pet"), F.lpad(F.col("entity_id").cast("string"), 3, "0"))
    blocks = notes_d(spark, sf).withColumn("pet_id", pet)
    notes.format_note_blocks(blocks).write.text(path)
    return notes.read_note_blocks(spark, path).select(
        "pet_id",
        "date",
        F.length("note_text").alias("note_length"),
        F.md5(F.col("note_text").cast("binary")).alias("note_md5"),
    )


@query(
    "missing_notes_join",
    f"WITH {READINGS_E} SELECT event_id, entity_id, date, value, CAST(NULL AS VARCHAR) AS note_text FROM readings",
)
def missing_notes_join(spark, sf):
    """A note source that does not exist acts as an empty table."""
    schema = schemas.struct(entity_id="bigint", date="date", note_text="string")
    absent = scratch_path(spark, "absent")
    empty = tables.read_or_empty(spark, lambda: tables.read_parquet(spark, absent, schema), schema)
    readings = readings_e(spark, sf).drop("category")
    return joins.attach_notes(readings, empty, ("entity_id", "date")).select(
        "event_id", "entity_id", "date", "value", "note_text"
    )


@query(
    "land_partition_overwrite",
    f"""WITH {READINGS_E}, last AS (SELECT max(date) AS d FROM readings)
    SELECT event_id, entity_id, date, category,
      CASE WHEN date = d THEN value + 1 ELSE value END AS value FROM readings, last""",
)
def land_partition_overwrite(spark, sf):
    """All days are landed, then a corrected last day replaces only its own partition."""
    path = scratch_path(spark, "landed")
    readings = readings_e(spark, sf)
    sinks.land(readings, path)
    corrected = aggregates.latest_date_rows(readings).withColumn("value", F.col("value") + 1)
    sinks.land(corrected, path)
    return tables.read_parquet(spark, path).select("event_id", "entity_id", "date", "category", "value")


DECLARED = schemas.struct(
    entity_id="bigint",
    date="date",
    quantity="int",
    water_intake="int",
    price="double",
    movement_count="int",
    discount="double",
)


@query(
    "schema_conformance",
    """SELECT 'entity_id' AS "column", 'bigint' AS type, count(l_suppkey) AS non_null FROM lineitem
    UNION ALL SELECT 'date', 'date', count(l_shipdate) FROM lineitem
    UNION ALL SELECT 'quantity', 'int', count(l_quantity) FROM lineitem
    UNION ALL SELECT 'water_intake', 'int', 0 FROM (SELECT count(*) FROM lineitem)
    UNION ALL SELECT 'price', 'double', count(l_extendedprice) FROM lineitem
    UNION ALL SELECT 'movement_count', 'int', 0 FROM (SELECT count(*) FROM lineitem)
    UNION ALL SELECT 'discount', 'double', count(l_discount) FROM lineitem""",
)
def schema_conformance(spark, sf):
    """Readings brought to a declared schema: casts, typed NULLs for missing columns."""
    return aggregates.profile_columns(cleanse.conform(readings_l(spark, sf), DECLARED))


@query(
    "manifest_explode",
    """SELECT p_partkey, 'names' AS kind, p_name AS file FROM part
    UNION ALL SELECT p_partkey, 'marks', p_brand FROM part
    UNION ALL SELECT p_partkey, 'marks', p_type FROM part""",
)
def manifest_explode(spark, sf):
    lists = F.create_map(
        F.lit("names"), F.array("p_name"), F.lit("marks"), F.array("p_brand", "p_type")
    ).alias("manifest")
    return cleanse.explode_manifest(table(spark, sf, "part").select("p_partkey", lists))


@query("normalize_key", "SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer")
def normalize_key(spark, sf):
    messy = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit(" \t"), F.upper("c_name"), F.lit("\r\n")).alias("c_name"),
        F.concat("c_mktsegment", F.lit(" ")).alias("c_mktsegment"),
    )
    return cleanse.normalize_key(messy, "c_name", "c_mktsegment")


@query(
    "lenient_dates",
    """WITH texts AS (SELECT o_orderkey, o_orderpriority, CASE
        WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y/%m/%d')
        WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%d/%m/%Y')
        ELSE 'day ' || o_orderpriority END AS text FROM orders)
    SELECT o_orderkey, CAST(coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%Y/%m/%d'),
                                     try_strptime(text, '%d/%m/%Y')) AS DATE) AS date
    FROM texts WHERE coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%Y/%m/%d'),
                              try_strptime(text, '%d/%m/%Y')) IS NOT NULL""",
)
def lenient_dates(spark, sf):
    kind, day = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(kind == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(kind == "2-HIGH", F.date_format(day, "yyyy/MM/dd"))
        .when(kind == "5-LOW", F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.concat(F.lit("day "), kind))
    )
    texts = table(spark, sf, "orders").select("o_orderkey", text.alias("date"))
    return cleanse.parse_date_any(texts, "date")


@query(
    "lenient_numeric",
    """SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS k
    FROM events WHERE event_type <> 'error'""".replace("\\\\", "\\"),
)
def lenient_numeric(spark, sf):
    """Numbers from JSON text; the unreadable ones are dropped."""
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.get_json_object("props", "$.k"))
    return cleanse.coerce_numeric(table(spark, sf, "events").select("event_id", text.alias("k")), "k")


@query(
    "fill_missing",
    """SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0.05), 0) AS l_discount,
       coalesce(nullif(l_tax, 0.03), 0) AS l_tax, coalesce(nullif(l_quantity, 7), 0) AS l_quantity FROM lineitem""",
)
def fill_missing(spark, sf):
    gaps = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.05)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.03)).alias("l_tax"),
        F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"),
    )
    return cleanse.fill_missing(gaps, ["l_discount", "l_tax", "l_quantity"])


@query(
    "over_threshold",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem WHERE l_quantity > 45",
)
def over_threshold(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return cleanse.over_threshold(rows, "l_quantity", 45)


@query(
    "melt_metrics",
    """SELECT order_id, line, category, metric, value FROM (
      SELECT l_orderkey AS order_id, l_linenumber AS line, l_returnflag AS category, 'Quantity' AS metric,
             l_quantity AS value FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, 'Price', l_extendedprice FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, 'discount', l_discount FROM lineitem)""",
)
def melt_metrics(spark, sf):
    long = cleanse.melt_metrics(
        readings_l(spark, sf), ["order_id", "line", "category"], ["quantity", "price", "discount"]
    )
    return cleanse.relabel(long, "metric", {"quantity": "Quantity", "price": "Price"})


@query(
    "age_at_log",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, 1950 + c_nationkey AS birth_year,
       CAST(year(o_orderdate) - (1950 + c_nationkey) AS INTEGER) AS age_at_log
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def age_at_log(spark, sf):
    born = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity_id"), (F.col("c_nationkey") + 1950).alias("birth_year")
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("entity_id"), F.to_date("o_orderdate").alias("date")
    )
    return cleanse.with_age(joins.attach_profile(orders, born, "entity_id")).drop("entity_id")
