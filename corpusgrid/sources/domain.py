"""Reading and writing collections stored as Parquet datasets."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgrid.operators.lifecycle import by_period

N_SHARDS = 5


def as_documents(df: DataFrame, index: str, type_: str, id_column: str, routing: Column | None = None,
                 version: Column | None = None) -> DataFrame:
    """Add the metadata columns to a plain table."""
    return df.select(
        F.lit(index).alias("_index"), F.lit(type_).alias("_type"), F.col(id_column).cast("string").alias("_id"),
        (version if version is not None else F.lit(1)).cast("long").alias("_version"),
        (routing if routing is not None else F.lit(None)).cast("string").alias("_routing"), "*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Several indices or types searched as one; absent fields are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_domain(targets: dict[str, DataFrame], names: list[str] | None = None,
                types: list[str] = ()) -> DataFrame:
    """Documents of the named indices (default all), maybe of some types only."""
    chosen = list(targets) if names is None else names
    unknown = [n for n in chosen if n not in targets]
    if unknown:
        raise ValueError(f"unknown domain {unknown}")
    out = union_all([targets[n] for n in chosen])
    return out.filter(F.col("_type").isin(list(types))) if types else out


@dataclass(frozen=True)
class AliasTarget:
    """One index behind an alias, with its own filter and routing."""

    df: DataFrame
    filter_: Column | None = None
    routing: tuple = ()
    n_shards: int = N_SHARDS


def read_alias(targets: dict[str, AliasTarget], routing: tuple | None = None) -> DataFrame:
    """Union of the targets under their filters. An explicit routing replaces theirs."""
    frames = []
    for target in targets.values():
        df = target.df if target.filter_ is None else target.df.filter(target.filter_)
        values = target.routing if routing is None else routing
        frames.append(routed(df, values, target.n_shards) if values else df)
    return union_all(frames)


def create_alias(spark: SparkSession, name: str, targets: dict[str, AliasTarget]) -> None:
    """Publish an alias as a view; replacing it switches all readers at once."""
    read_alias(targets).createOrReplaceTempView(name)


def write_target(targets: dict[str, AliasTarget]) -> str:
    """The index writes go to: an alias of exactly one."""
    if len(targets) != 1:
        raise ValueError("cannot write to an alias of several indices")
    return next(iter(targets))


def shard_of(routing: Column, n_shards: int = N_SHARDS) -> Column:
    return F.pmod(F.xxhash64(routing), F.lit(n_shards)).cast("int")


def routed(df: DataFrame, values, n_shards: int = N_SHARDS) -> DataFrame:
    """Rows routed by one of the values; stored shards are pruned to theirs."""
    values = list(values)
    out = df.filter(F.coalesce("_routing", "_id").isin(values))
    if "_shard" in df.columns:
        wanted = reduce(lambda a, b: a | b, [F.col("_shard") == shard_of(F.lit(v), n_shards) for v in values])
        out = out.filter(wanted)
    return out


def write_index(df: DataFrame, path: str, n_shards: int = N_SHARDS, mode: str = "errorifexists") -> None:
    """Store a collection in shards by hash of routing (or id).

    A shard may be far bigger than the rest (one tenant with a third of all
    rows); the rebalance splits it over several tasks and files.
    """
    sharded = df.withColumn("_shard", shard_of(F.coalesce("_routing", "_id"), n_shards))
    (sharded.hint("rebalance", "_type", "_shard")
        .write.mode(mode).partitionBy("_type", "_shard").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_periods(df: DataFrame, path: str, field: str, period: str = "month") -> None:
    """One time-based index per period, as partitions of one dataset."""
    (by_period(df, field, period).hint("rebalance", "_period")
        .write.partitionBy("_period").parquet(path))


def get(docs: DataFrame, ids: DataFrame, on: list[str], strict: bool = True) -> DataFrame:
    """Point look-up of an id table; a missing id fails the job, or gives nulls."""
    found = docs.withColumn("_found", F.lit(True))
    joined = ids.join(found, on, "left")
    if strict:
        check = F.when(F.col("_found").isNull(), F.raise_error(
            F.concat(F.lit("missing document "), F.concat_ws("/", *on))).cast("boolean")).otherwise(True)
        joined = joined.filter(check)
    return joined.drop("_found")


def exists(docs: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """One boolean per asked id."""
    found = ids.select(*on).distinct().join(docs.select(*on), on, "left_semi").withColumn("_found", F.lit(True))
    return ids.join(found, on, "left").select(*on, F.col("_found").isNotNull().alias("exists"))
