"""Collections in hash buckets of their key, read through a manifest.

Files lie in ``rows/_generation=<g>/_bucket=<b>`` and never change. A manifest row names
the generation of every bucket; appending the next row, one file, switches all readers at
once. A write reads the buckets its batch touches, and writes these alone as a new
generation, so the other buckets keep their files. A look-up of known keys joins on bucket
and key: the bucket is a partition column, which Spark prunes while the query runs.

A writer whose version has been followed by another one raises before it publishes, and
one that finds another's row beside its own, with a smaller token, raises after.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from corpusgrid.operators.writes import WriteResult

N_BUCKETS = 64
FEW_KEYS = 10_000
MANIFEST = "version long, token string, n_buckets int, key array<string>, schema string, buckets map<int, string>, note string"


class WriteRace(Exception):
    """Another writer has published the next version first."""


@dataclass(frozen=True)
class BucketStore:
    """One version of a stored collection; ``update`` gives the next one."""

    spark: SparkSession
    path: str
    key: tuple
    n_buckets: int
    version: int
    buckets: dict  # bucket: generation
    schema: StructType
    note: str | None = None

    @classmethod
    def create(cls, df: DataFrame, path: str, key: list[str], n_buckets: int = N_BUCKETS) -> BucketStore:
        empty = cls(df.sparkSession, path, tuple(key), n_buckets, 0, {}, df.schema)
        return empty.replace_buckets(df, range(n_buckets))

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> BucketStore:
        """The newest version, or an older one; its manifest is one row."""
        manifests = spark.read.schema(MANIFEST).parquet(f"{path}/manifests")
        if version is not None:
            manifests = manifests.where(F.col("version") == version)
        row = manifests.orderBy(F.desc("version"), "token").first()
        if row is None:
            raise ValueError(f"no version {version} at {path}")
        return cls(spark, path, tuple(row["key"]), row["n_buckets"], row["version"], row["buckets"],
                   StructType.fromJson(json.loads(row["schema"])), row["note"])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.n_buckets)).cast("int")

    def read(self, buckets=None, with_bucket: bool = False) -> DataFrame:
        """The rows of this version, or of some of its buckets."""
        chosen = {b: g for b, g in self.buckets.items() if buckets is None or b in set(buckets)}
        columns = [*(["_bucket"] if with_bucket else []), *self.schema.names]
        if not chosen:
            return self.spark.createDataFrame([], self.schema).withColumn("_bucket", F.lit(0)).select(*columns)
        paths = [f"{self.path}/rows/_generation={g}/_bucket={b}" for b, g in sorted(chosen.items())]
        stored = StructType([*self.schema.fields, StructField("_generation", StringType()), StructField("_bucket", IntegerType())])
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(*paths).select(*columns)

    def find(self, keys: DataFrame, few: int | None = None) -> DataFrame:
        """Stored rows with the other columns of ``keys``, which has the key columns.

        A number of keys that the caller has bounded by ``few`` is broadcast up to
        ``FEW_KEYS``, and only the buckets of these keys are read; more keys are shuffled.
        """
        asked = keys.withColumn("_bucket", self.bucket())
        if few is not None and few <= FEW_KEYS:
            asked = F.broadcast(asked)
        return self.read(with_bucket=True).join(asked, ["_bucket", *self.key]).drop("_bucket")

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets of the keys of a batch; ``n_buckets`` numbers at most."""
        return sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())

    def update(self, batch: DataFrame, change: Callable) -> tuple[BucketStore, DataFrame | WriteResult]:
        """``change(current, batch)`` on the touched buckets alone: (next version, what it gave).

        ``change`` gives the new rows or a ``WriteResult``, and may write keys of the batch only.
        """
        touched = self.touched(batch)
        result = change(self.read(touched), batch)
        rows = result.snapshot if isinstance(result, WriteResult) else result
        return self.replace_buckets(rows, touched), result

    def replace_buckets(self, rows: DataFrame, buckets, note: str | None = None) -> BucketStore:
        """Publishes a version in which some buckets hold ``rows`` and nothing else."""
        token = uuid.uuid4().hex
        generation = f"{self.version + 1}-{token[:12]}"
        self.write_generation(rows, generation)
        return self.publish({**{b: g for b, g in self.buckets.items() if b not in set(buckets)},
                             **{b: generation for b in self.written(rows, generation, set(buckets))}},
                            rows.schema, token, note)

    def write_generation(self, rows: DataFrame, generation: str) -> None:
        (rows.withColumn("_bucket", self.bucket()).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *self.key)
         .write.partitionBy("_bucket").parquet(f"{self.path}/rows/_generation={generation}"))

    def written(self, rows: DataFrame, generation: str, allowed: set) -> list[int]:
        """The buckets that got rows, from the folders of the generation."""
        stored = StructType([*rows.schema.fields, StructField("_bucket", IntegerType())])
        found = self.spark.read.schema(stored).parquet(f"{self.path}/rows/_generation={generation}").select("_bucket").distinct()
        got = sorted(r[0] for r in found.collect())
        if not set(got) <= allowed:
            raise ValueError("rows outside of the buckets that are replaced")
        return got

    def publish(self, buckets: dict, schema: StructType, token: str, note: str | None = None) -> BucketStore:
        row = (self.version + 1, token, self.n_buckets, list(self.key), schema.json(), buckets, note)
        if self.version and self.published() is not None:
            raise WriteRace(f"version {self.version + 1} of {self.path} is another writer's")
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifests")
        if self.published() != token:
            raise WriteRace(f"version {self.version + 1} of {self.path} is another writer's")
        return BucketStore(self.spark, self.path, self.key, self.n_buckets, self.version + 1, buckets, schema, note)

    def published(self) -> str | None:
        """The token of the next version, if there is one by now."""
        manifests = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests")
        return manifests.where(F.col("version") == self.version + 1).agg(F.min("token")).first()[0]
