"""A collection loaded by a stream and kept in two levels: buckets, and deltas over them.

Each micro-batch writes its rows as ``deltas/_batch=<id>/_bucket=<b>``, in the buckets of
the base; a deleted document is a row marked ``_deleted``. A batch looks up the buckets of
its own ids only, in the base and in the deltas. ``compact`` folds deltas into the buckets
they touch and publishes the next version of the base, whose note says up to which batch it
goes; the stream and all readers take deltas after that one. A batch that is repeated
replaces its own folder, or does nothing if the base holds it already.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from corpusgrid.operators import writes
from corpusgrid.operators.writes import KEY
from corpusgrid.sources.snapshots import N_BUCKETS, BucketStore

GONE = "_deleted"


def create_levels(spark: SparkSession, path: str, schema: StructType, n_buckets: int = N_BUCKETS) -> BucketStore:
    """An empty collection; ``schema`` has the key, ``_version`` and the document fields."""
    with_mark = StructType([*(f for f in schema.fields if f.name != GONE), StructField(GONE, BooleanType())])
    base = BucketStore.create(spark.createDataFrame([], with_mark), f"{path}/base", KEY, n_buckets)
    return base.publish({}, with_mark, "start", "-1")


def deltas(base: BucketStore, path: str, before: int | None = None) -> DataFrame:
    """Rows of batches that the base does not hold, with ``_batch`` and ``_bucket``."""
    stored = StructType([*base.schema.fields, StructField("_batch", LongType()), StructField("_bucket", IntegerType())])
    try:
        rows = base.spark.read.schema(stored).parquet(f"{path}/deltas")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = base.spark.createDataFrame([], stored)
    rows = rows.filter(F.col("_batch") > int(base.note))
    return rows if before is None else rows.filter(F.col("_batch") < before)


def newest(base: BucketStore, path: str, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
    """The last row of each id, deletions too; a later batch wins, then a higher version."""
    recent = deltas(base, path, before)
    if buckets is not None:
        recent = recent.filter(F.col("_bucket").isin(buckets))
    rows = base.read(buckets).withColumn("_batch", F.lit(-1).cast("long")).unionByName(recent.drop("_bucket"))
    body = [c for c in base.schema.names if c not in KEY]
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*body), F.struct("_batch", "_version")).alias("r")).select(*KEY, "r.*").select(*base.schema.names)


def live() -> Column:
    return ~F.coalesce(F.col(GONE), F.lit(False))


def read_levels(spark: SparkSession, path: str) -> DataFrame:
    """The documents there are now."""
    return newest(BucketStore.open(spark, f"{path}/base"), path).filter(live()).drop(GONE)


def apply_batch(batch: DataFrame, batch_id: int, path: str, mode: str) -> None:
    """One micro-batch: ``_seq`` is its order, a row with ``_deleted`` removes its id.

    With ``overwrite`` versions go on over a deletion; with ``save`` and ``create`` an id that
    an earlier batch deleted is new.
    """
    base = BucketStore.open(batch.sparkSession, f"{path}/base")
    if batch_id <= int(base.note):
        return
    current = newest(base, path, base.touched(batch), batch_id)
    if mode == "overwrite":
        rows = writes.overwritten(current, batch)
    else:
        result = (writes.create if mode == "create" else writes.write)(current.filter(live()), batch)
        rows = result.success
        (result.conflicts.select(*KEY, "_seq", "error").write.mode("overwrite").parquet(f"{path}/conflicts/_batch={batch_id}"))
    (rows.select(*base.schema.names).withColumn("_bucket", base.bucket()).hint("rebalance", "_bucket")
     .write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/deltas/_batch={batch_id}"))


def compact(spark: SparkSession, path: str, purge: bool = False) -> BucketStore:
    """Folds all deltas there are into their buckets.

    Deletions stay as marked rows, so that versions go on over them whenever it is folded;
    ``purge`` drops those of the folded buckets, and their ids begin anew.
    """
    base = BucketStore.open(spark, f"{path}/base")
    waiting = deltas(base, path)
    last = waiting.agg(F.max("_batch")).first()[0]
    if last is None:
        return base
    touched = sorted(r[0] for r in waiting.filter(F.col("_batch") <= last).select("_bucket").distinct().collect())
    rows = newest(base, path, touched, last + 1)
    return base.replace_buckets(rows.filter(live()) if purge else rows, touched, str(last))


def stream_levels(stream: DataFrame, path: str, checkpoint: str, mode: str = "save", compact_every: int | None = None) -> StreamingQuery:
    """Versioned writes from a stream, with a compaction after every so many batches."""
    if mode not in ("save", "create", "overwrite"):
        raise ValueError(f"unknown mode '{mode}'")
    if GONE not in stream.columns:
        stream = stream.withColumn(GONE, F.lit(False))
    spark = stream.sparkSession
    try:
        BucketStore.open(spark, f"{path}/base")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        create_levels(spark, path, StructType([f for f in stream.schema.fields if f.name != "_seq"]))

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, path, mode)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
