"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "entityhealth", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A `local[...]` session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. A folder of this machine is
    used only by a local session that names none.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="entityhealth-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fixed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, so that every use sees the same ones.

    Needed where a plan depends on samples or sketches. Lost executors do not
    lose the rows, and nothing before them runs twice.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whatever reads them next."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch folder."""
    return f"{scratch_root(spark)}/entityhealth/{label}-{uuid.uuid4().hex}"
