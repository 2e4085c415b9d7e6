"""Session-level helpers: shared storage, and spreading undersized scans."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a fresh folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="corpusgrid-")
    return _LOCAL_DIRS[app]


def table_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for one written table inside the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to shared storage, with options of the writer, and read it back.

    Cuts lineage in a way that survives lost executors.
    """
    path = table_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than cores.

    One small file is one task, so heavy per-row work (tokenising) would run on
    one core. Big inputs have plenty of splits and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def literal_rows(spark: SparkSession, **columns: list) -> DataFrame:
    """A few rows given by the caller, as a local relation of known size."""
    return spark.createDataFrame(pa.table(columns))
