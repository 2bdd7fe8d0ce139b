"""Readers of structured files: CSV, JSON, Parquet, the media manifest."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityhealth import schemas
from entityhealth.functions.dates import parse_date
from entityhealth.functions.numbers import to_number
from entityhealth.functions.text import normalize_key
from entityhealth.operators.cleanse import conform


#: Only this ends a row, so that other line ends inside a quoted cell stay as they are.
LINES = {"lineSep": "\n"}


def _typed(df: DataFrame, schema: T.StructType, date_format: str) -> DataFrame:
    """Text columns to the declared types; what does not parse becomes NULL."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(parse_date(F.col(f.name), date_format).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            out.append(to_number(F.col(f.name), f.dataType.simpleString()).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_activity_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.ACTIVITY,
    columns: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    date_format: str = "yyyy-MM-dd",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row, as typed readings.

    A quote inside a quoted cell is doubled. Cells with line ends need
    `multi_line`; a file is then one task, so large inputs come in many files.

    `columns` is the column order in the file (that of `schema` by default),
    `rename` maps file names to schema names. All cells are read as text, so no
    row gets lost over a bad cell; there is no inference pass.
    """
    names = list(columns or schema.fieldNames())
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(text).options(header=True, enforceSchema=False, escape='"')
    raw = reader.options(multiLine=multi_line, **LINES).csv(path)
    if rename:
        raw = raw.withColumnsRenamed(dict(rename))
    return _typed(raw, schema, date_format)


def read_report(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """All part files of a CSV report directory, with the report's own schema.

    `multi_line` is for reports with free text; a part file is then one task.
    """
    reader = spark.read.schema(schema).options(header=True, escape='"')
    return reader.options(multiLine=multi_line, **(LINES if multi_line else {})).csv(path)


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType, layout: str = "lines"
) -> DataFrame:
    """JSON records: one object per line (`lines`, splittable) or one array per file (`array`)."""
    if layout not in ("lines", "array"):
        raise ValueError("layout is 'lines' or 'array'")
    return spark.read.schema(schema).option("multiLine", layout == "array").json(path)


def read_profiles(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Profile records with keys and species in one spelling."""
    raw = read_json_records(spark, path, schemas.PROFILE, layout)
    return raw.withColumns({c: normalize_key(F.col(c)) for c in ("pet_id", "species")})


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of name lists, as one map column `manifest` per file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", schemas.MANIFEST).alias("manifest"))


def read_or_empty(spark: SparkSession, reader: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """The source, or an empty typed table where the path does not exist.

    Any other error is raised: a broken file must not look like an empty one.
    """
    try:
        return reader()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)
