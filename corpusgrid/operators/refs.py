"""Following references between documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.operators.schema import embed


def resolve_refs(df: DataFrame, ref: str, target: DataFrame, target_key: str, name: str = "doc",
                 strict: bool = False) -> DataFrame:
    """Fetch the document behind a reference; ``deleted`` marks a lost target.

    With ``strict`` a lost target fails the job.
    """
    packed = target.select(F.col(target_key).alias("_t"), F.struct("*").alias(name))
    joined = df.join(packed, F.col(ref) == F.col("_t"), "left")
    lost = F.col(ref).isNotNull() & F.col("_t").isNull()
    if strict:
        lost = F.when(lost, F.raise_error(F.concat(F.lit("deleted document: "), F.col(ref).cast("string")))
                      .cast("boolean")).otherwise(F.lit(False))
    return joined.withColumn("deleted", lost).drop("_t")


def semi_by_values(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Two-step join: ids found by one search restrict another."""
    return df.join(other.select(F.col(other_column).alias(column)), column, "left_semi")


def reembed(df: DataFrame, name: str, key: Column, ref: DataFrame, ref_key: str, uid: Column,
            include_attrs: list[str]) -> DataFrame:
    """Refresh embedded copies after the referenced documents changed."""
    keyed = df.withColumn("_k", key).drop(name)
    return embed(keyed, ref, "_k", ref_key, name, uid, include_attrs).drop("_k")
