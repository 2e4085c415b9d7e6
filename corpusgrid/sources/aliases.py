"""Names of stored collections that switch for all readers at once.

A folder holds one small row for every switch: the alias, its number, and the stores behind
it by index. Readers take the newest row, so they see the old collection or the new one and
never a part; a destination is written and published whole before the alias names it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgrid.operators.lifecycle import reindex
from corpusgrid.operators.writes import KEY
from corpusgrid.sources.domain import union_all
from corpusgrid.sources.snapshots import BucketStore

SWITCHES = "alias string, number long, targets map<string, struct<path: string, version: long>>"


@dataclass(frozen=True)
class Aliases:
    spark: SparkSession
    path: str

    def switches(self) -> DataFrame:
        try:
            return self.spark.read.schema(SWITCHES).parquet(self.path)
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SWITCHES)

    def newest(self, alias: str):
        return self.switches().filter(F.col("alias") == alias).orderBy(F.desc("number")).first()

    def point(self, alias: str, stores: dict[str, BucketStore]) -> None:
        """From now on the alias reads these versions of these stores."""
        row = self.newest(alias)
        targets = {index: (s.path, s.version) for index, s in stores.items()}
        (self.spark.createDataFrame([(alias, row["number"] + 1 if row else 0, targets)], SWITCHES).coalesce(1)
         .write.mode("append").parquet(self.path))

    def stores(self, alias: str) -> dict[str, BucketStore]:
        row = self.newest(alias)
        if row is None:
            raise ValueError(f"unknown alias '{alias}'")
        return {index: BucketStore.open(self.spark, t["path"], t["version"]) for index, t in sorted(row["targets"].items())}

    def read(self, alias: str) -> DataFrame:
        return union_all([s.read() for s in self.stores(alias).values()])

    def reindex(self, alias: str, dest: str, path: str, existing: DataFrame | None = None,
                transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Copies what the alias reads into the new index ``dest`` at ``path`` and switches to it;
        the conflicts with ``existing`` documents. If the copy fails the alias stays as it was."""
        rows, _, conflicts = reindex(self.read(alias), dest, existing, transform)
        self.point(alias, {dest: BucketStore.create(rows, path, KEY)})
        return conflicts
