"""Continuous loading and filtering with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from corpusgrid.operators import writes
from corpusgrid.operators.writes import KEY


def stream_filter(stream: DataFrame, predicate: Column, analysis: dict[str, Column] | None = None) -> DataFrame:
    """Any filter and any analysis on a stream; both are stateless."""
    return stream.filter(predicate).withColumns(analysis or {})


def latest(deltas: DataFrame) -> DataFrame:
    """Current rows of a collection stored as deltas: the highest version per id."""
    body = [c for c in deltas.columns if c not in (*KEY, "_batch")]
    return (deltas.groupBy(*KEY).agg(F.max_by(F.struct(*body), "_version").alias("r"))
            .select(*KEY, "r.*"))


def _read_deltas(spark: SparkSession, path: str, schema: StructType, before: int) -> DataFrame:
    """Deltas of earlier batches; the batch number prunes the listing."""
    try:
        deltas = spark.read.schema(StructType([*schema.fields, StructField("_batch", LongType())])).parquet(f"{path}/rows")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # nothing written yet
    return deltas.filter(F.col("_batch") < before).drop("_batch")


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, mode: str = "save",
                  conflicts: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Versioned writes from a stream into ``path``.

    Each micro-batch writes only its accepted rows, as delta ``_batch=<id>``, and
    its conflicts next to them. Rewriting the same id replaces the same folder,
    so a repeated batch changes nothing. Only ids of the batch are looked up.
    """
    if mode not in ("save", "create", "overwrite"):
        raise ValueError(f"unknown mode '{mode}'")
    fields = [f for f in stream.schema.fields if f.name != "_seq"]
    schema = StructType(fields)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = _read_deltas(spark, path, StructType(list(fields)), batch_id)
        current = latest(earlier.join(batch.select(*KEY).distinct(), KEY, "left_semi"))
        if mode == "overwrite":
            rows, failed = writes.overwritten(current, batch), None
        else:
            result = writes.create(current, batch) if mode == "create" else writes.write(current, batch)
            rows, failed = result.success, result.conflicts
        rows.select(*schema.names).write.mode("overwrite").parquet(f"{path}/rows/_batch={batch_id}")
        if failed is not None:
            (failed.select(*KEY, "_seq", "error").write.mode("overwrite")
                .parquet(f"{path}/conflicts/_batch={batch_id}"))
            if conflicts is not None:
                conflicts(failed, batch_id)

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return latest(spark.read.parquet(f"{path}/rows"))


def compact(spark: SparkSession, path: str, out: str) -> None:
    """Fold all deltas into one dataset with a single version per id."""
    read_upserted(spark, path).write.parquet(out)
