"""Bounded memory of Python workers."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """Sets the session to Arrow batches of few rows, as texts may be long.

    A batch lives in the executor, in its Python worker and on the way; the rows in a
    batch have no influence on results.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def tidy() -> None:
    """Hands freed memory back at the end of a task, as workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
