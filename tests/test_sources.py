import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from entityhealth import schemas
from entityhealth.operators import cleanse
from entityhealth.sources import devicelog, notes, sinks, tables

D = dt.date


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_activity_csv_keeps_rows_with_bad_cells(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        ",".join(schemas.ACTIVITY.fieldNames())
        + "\npet001,2025-01-02,200,12.5,3,4.5,Miu,cat,Bengal,male,2019\n"
        + "pet002,2025-13-02,x,NaN,3.0,,Rex,dog,Persian,female,2015.0\n",
    )
    a, b = tables.read_activity_csv(spark, path).orderBy("pet_id").collect()
    assert (a.date, a.food_amount, a.meow_count, a.birth_year) == (D(2025, 1, 2), 200.0, 3, 2019)
    assert (b.date, b.food_amount, b.sleep_hours, b.weight_kg) == (None,) * 4
    assert (b.name, b.meow_count, b.birth_year) == ("Rex", 3, 2015)


def test_activity_csv_with_other_columns(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "pet_id,name,species,breed,date,food_amount_kg,sleep_hours,weight_kg,meow_count\n"
        "pet001,Milo,Dog,Poodle,2025-08-02,1.03,10.61,14.97,27\n",
    )
    columns = "pet_id name species breed date food_amount_kg sleep_hours weight_kg meow_count".split()
    df = tables.read_activity_csv(spark, path, columns=columns, rename={"food_amount_kg": "food_amount"})
    r = cleanse.normalize_key(df, "species").first()
    assert df.schema == schemas.ACTIVITY
    assert (r.species, r.food_amount, r.meow_count, r.gender) == ("dog", 1.03, 27, None)


def test_json_layouts(spark, tmp_path):
    one = '{"pet_id": " PET%03d", "name": "n", "species": "Dog", "breed": "b", "gender": "male", "birth_year": 2020}'
    lines = write(tmp_path / "lines.json", "\n".join(one % i for i in range(3)))
    array = write(tmp_path / "array.json", "[\n" + ",\n".join(one % i for i in range(3)) + "\n]")
    for path, layout in ((lines, "lines"), (array, "array")):
        got = tables.read_profiles(spark, path, layout).orderBy("pet_id").collect()
        assert [(r.pet_id, r.species) for r in got] == [(f"pet{i:03d}", "dog") for i in range(3)]
    with pytest.raises(ValueError):
        tables.read_json_records(spark, lines, schemas.PROFILE, "xml")


NOTES = (
    "a preamble\n\n# Pet ID: pet000 - Notes on 2025-08-02\n  Ăn khỏe. \n\n"
    "# Pet ID: PET001 - Notes on 2025-08-03\nfirst line\nsecond line\n\n"
    "# Pet ID: dog7 - Notes on 2025-08-03\nno valid header\n"
    "# Pet ID: pet002 - Notes on 2025-08-04"
)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_note_blocks(spark, tmp_path, rows, newline):
    path = write(tmp_path / "n.md", NOTES.replace("\n", newline))
    assert rows(notes.read_note_blocks(spark, path)) == [
        ("pet000", D(2025, 8, 2), "Ăn khỏe."),
        ("pet001", D(2025, 8, 3), "first line\nsecond line"),
    ]


def test_note_file_without_headers_is_empty(spark, tmp_path):
    path = write(tmp_path / "n.md", "Miu không ăn nhiều hôm nay.\nCó cần đưa đi khám không?\n")
    assert notes.read_note_blocks(spark, path).count() == 0


def test_note_blocks_survive_splits(spark, tmp_path):
    body = "".join(f"# Pet ID: pet{i % 1000:03d} - Notes on 2025-01-01\nghi chú {i} {'x' * (i % 97)}\n\n" for i in range(20000))
    path = write(tmp_path / "n.md", body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        df = notes.read_note_blocks(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert df.count() == 20000
        assert df.agg(F.countDistinct("note_text")).first()[0] == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# The golden input of the log format.
LOG = (
    "[INFO] 2025-06-25 08:03:21 - Pet Miu started eating.\n"
    "[INFO] 2025-06-25 08:04:45 - Pet Miu meowed continuously.\n"
    "[WARN] 2025-06-25 08:05:00 - Unusual behavior detected: 5 meows in 2 minutes.\n"
    "[INFO] 2025-06-25 08:06:30 - Pet Miu stopped eating.\n"
)
MORE = (
    "[INFO] 2025-06-25 09:00:00 - Pet Miu Food Dispensed: 35g\n"
    "[WARN] 2025-06-25 09:01:00 - Pet Miu Feeder Jammed\n"
    "[INFO] 2025-99-25 09:01:00 - Pet Miu bad date\n"
)


def test_device_log(spark, tmp_path, rows):
    lines = devicelog.read_log_lines(spark, write(tmp_path / "l.txt", LOG + MORE))
    events = devicelog.parse_device_log(lines)
    assert events.schema.simpleString() == schemas.DEVICE_EVENT.simpleString()
    assert events.where("pet_name_from_log = 'Miu'").count() == 6
    assert events.where("log_level = ''").count() == 1
    daily = devicelog.mapped_only(devicelog.map_names(devicelog.device_daily_summary(events), {"Miu": "pet001"}))
    got = rows(daily.drop("pet_name_from_log"))
    assert got == [("2025-06-25", 35, 1, 0, "pet001"), (None, None, 0, 0, "pet001")] or got == [
        (None, None, 0, 0, "pet001"),
        ("2025-06-25", 35, 1, 0, "pet001"),
    ]
    assert devicelog.with_jams(daily).count() == 1


def test_device_log_lines_without_a_name(spark, tmp_path):
    lines = devicelog.read_log_lines(spark, write(tmp_path / "l.txt", LOG))
    events = devicelog.parse_device_log(lines, entity_optional=True)
    r = events.where("pet_name_from_log = ''").first()
    assert (r.log_level, r.log_timestamp, r.unusual_behavior_detected) == ("WARN", dt.datetime(2025, 6, 25, 8, 5), True)


def test_device_log_fields_equal_the_line_pattern(spark):
    lines = [
        "[INFO] 2025-06-25 08:03:21 - Pet Miu started eating.",
        "noise [WARN] 2025-06-25 08:03:21 - Pet Miu x [INFO] 2025-06-25 08:03:22 - Pet Rex y",
        "[INFO] 2025-06-25 08:03:21 - Pet  two blanks",
        "[INFO] 2025-06-25 08:03:21 - Pet Miu",
        "[INFO] 2025-06-25 08:03:21 - no name [WARN] 2025-06-26 08:03:21 - Pet Rex late",
        "[DEBUG] 2025-06-25 08:03:21 - Pet Miu x",
        "[INFO] 2025-06-25 8:03:21 - Pet Miu x",
        "",
    ]
    head = r"\[(INFO|WARN)\] (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - "
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    for optional, pattern in ((False, head + "Pet (.*?) (.*)"), (True, head + "(?:Pet (.*?) )?(.*)")):
        got = devicelog.parse_device_log(df, optional).collect()
        for text, r in zip(lines, got, strict=True):
            m = re.search(pattern, text)
            level, stamp, name, message = [g or "" for g in m.groups()] if m else [""] * 4
            assert (r.log_level, r.pet_name_from_log, r.log_message) == (level, name, message), text
            assert str(r.log_timestamp or "") == stamp


def test_read_or_empty(spark, tmp_path):
    absent = tables.read_or_empty(spark, lambda: notes.read_note_blocks(spark, f"{tmp_path}/none"), schemas.NOTE)
    assert absent.schema == schemas.NOTE and absent.count() == 0
    broken = write(tmp_path / "b.parquet", "no parquet")
    with pytest.raises(Exception):
        tables.read_or_empty(spark, lambda: tables.read_parquet(spark, broken), schemas.NOTE).count()


def test_manifest(spark, tmp_path, rows):
    path = write(tmp_path / "m.json", '{\n "audio": ["a.wav", "b.wav"],\n "text": ["t.txt"]\n}')
    got = rows(cleanse.explode_manifest(tables.read_manifest(spark, path)))
    assert got == [("audio", "a.wav"), ("audio", "b.wav"), ("text", "t.txt")]


def test_report_text_survives_csv(spark, tmp_path, rows):
    data = [("a", ' "quoted", with\nline ends '), ("b", None), ("c", "plain\\")]
    schema = schemas.struct(k="string", t="string")
    sinks.write_report(spark.createDataFrame(data, schema), f"{tmp_path}/r")
    assert rows(tables.read_report(spark, f"{tmp_path}/r", schema, multi_line=True)) == sorted(data)


def test_single_file_export_keeps_the_order(spark, tmp_path):
    """Part files of very different sizes are packed in another order than their own."""
    schema = schemas.struct(k="bigint", t="string")
    sizes = {0: 3, 1: 400, 2: 1, 3: 900, 4: 20, 5: 2000}
    data = [(p * 10_000 + i, "x" * (i % 50)) for p, n in sizes.items() for i in range(n)]
    for p in sizes:
        part = spark.createDataFrame([r for r in data if r[0] // 10_000 == p], schema).coalesce(1)
        sinks.write_report(part, f"{tmp_path}/p{p}")
        (tmp_path / "r").mkdir(exist_ok=True)
        source = next((tmp_path / f"p{p}").glob("part-*.csv"))
        (tmp_path / "r" / f"part-{p:05d}.csv").write_bytes(source.read_bytes())
    sinks.export_single_file(spark, f"{tmp_path}/r", f"{tmp_path}/one", schema)
    files = list((tmp_path / "one").glob("part-*"))
    assert len(files) == 1
    keys = [int(line.split(",")[0]) for line in files[0].read_text().splitlines()[1:]]
    assert keys == [k for k, _ in data]


def test_readings_with_quotes_and_line_ends(spark, tmp_path):
    data = [("a", 'Rex "Max", jr'), ("b", "two\nlines\r\nthree"), ("c", '"'), ("d", "back\\slash,"), ("e", None)]
    schema = schemas.struct(pet_id="string", name="string")
    sinks.write_report(spark.createDataFrame(data, schema), f"{tmp_path}/r")
    back = tables.read_activity_csv(spark, f"{tmp_path}/r", schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == data


def test_landing_replaces_only_its_days(spark, tmp_path, rows):
    path = f"{tmp_path}/landed"
    schema = "k int, date date"
    sinks.land(spark.createDataFrame([(1, D(2025, 1, 1)), (2, D(2025, 1, 2))], schema), path)
    kept = {f.name for f in (tmp_path / "landed" / "date=2025-01-01").glob("*.parquet")}
    sinks.land(spark.createDataFrame([(3, D(2025, 1, 2)), (4, D(2025, 1, 3))], schema), path)
    assert rows(spark.read.parquet(path)) == [(1, D(2025, 1, 1)), (3, D(2025, 1, 2)), (4, D(2025, 1, 3))]
    assert {f.name for f in (tmp_path / "landed" / "date=2025-01-01").glob("*.parquet")} == kept
    sinks.append_days(spark.createDataFrame([(5, D(2025, 1, 1))], schema), path)
    assert spark.read.parquet(path).count() == 4


def test_conform_and_lenient_columns(spark, rows):
    raw = spark.createDataFrame([("p", "2025-01-02", "12"), ("q", "x", "y")], "pet_id string, date string, food_amount string")
    out = cleanse.conform(raw, schemas.ACTIVITY_DECLARED)
    assert out.schema == schemas.ACTIVITY_DECLARED
    assert [r.food_amount for r in out.orderBy("pet_id").collect()] == [12, None]
    texts = ["2025-01-02", "2025/01/02", "02/01/2025", "02-01-2025", "2025-01-02 10:11:12", "2 Jan 2025", "2025-1-2x", "", None]
    dates = cleanse.parse_date_any(spark.createDataFrame([(t,) for t in texts], "d string"), "d")
    assert [r.d for r in dates.collect()] == [D(2025, 1, 2)] * 6
    numbers = cleanse.coerce_numeric(spark.createDataFrame([("1.5",), ("prediction",), (None,), ("NaN",)], "p string"), "p")
    assert [r.p for r in numbers.collect()] == [1.5]
    mixed = spark.createDataFrame([(" 7 ", "-1.5e3", 2.9, "x")], "a string, b string, c double, d string")
    cast = cleanse.cast_metrics(mixed, {"a": "int", "b": "double", "c": "int", "d": "int", "absent": "int"})
    assert tuple(cast.first()) == (7, -1500.0, 2, None)
