"""Index lifecycle as table jobs: reindex, and moving references along."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgrid.operators.writes import KEY


def _is_uid(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) and {"index", "type", "id"} <= set(dtype.names)


def uid_paths(schema: T.StructType, parent: str = "") -> list[str]:
    """Paths of all stored references (a field ``uid`` with index, type and id)."""
    out = []
    for f in schema.fields:
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if f.name == "uid" and _is_uid(inner):
            out.append(f"{parent}{f.name}")
        elif isinstance(inner, T.StructType):
            out += uid_paths(inner, f"{parent}{f.name}.")
    return out


def _rewrite(value: Column, dtype: T.DataType, name: str, change: Callable[[Column], Column]) -> Column | None:
    """The value with ``change`` applied to its references; None when it has none."""
    if isinstance(dtype, T.ArrayType):
        probe = _rewrite(F.lit(None), dtype.elementType, name, lambda c: c)
        return None if probe is None else F.transform(
            value, lambda e: _rewrite(e, dtype.elementType, name, change))
    if not isinstance(dtype, T.StructType):
        return None
    if name == "uid" and _is_uid(dtype):
        return change(value)
    parts = {f.name: _rewrite(value[f.name], f.dataType, f.name, change) for f in dtype.fields}
    if not any(p is not None for p in parts.values()):
        return None
    fields = [(parts[f.name] if parts[f.name] is not None else value[f.name]).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def rewrite_refs(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Apply a Column function to every stored reference, at any depth."""
    changed = {}
    for f in df.schema.fields:
        out = _rewrite(F.col(f.name), f.dataType, f.name, change)
        if out is not None:
            changed[f.name] = out
    return df.withColumns(changed) if changed else df


def repoint_internal(df: DataFrame, old_indices: list[str], dest: str) -> DataFrame:
    """References into the copied indices move to the new one."""
    def move(uid: Column) -> Column:
        return F.when(uid["index"].isin(old_indices), uid.withField("index", F.lit(dest))).otherwise(uid)
    return rewrite_refs(df, move)


def repoint_external(df: DataFrame, ref: str, moved: DataFrame, dest: str) -> tuple[DataFrame, DataFrame]:
    """References of another index to moved documents; ``(rows, changed ids)``.

    ``moved(index, type, id)`` is a table of any size, met by an equi-join.
    ``ref`` is the path of a reference struct. Changed rows get version + 1.
    """
    flagged = df.join(
        moved.select(*[F.col(c).alias(f"_m_{c}") for c in ("index", "type", "id")], F.lit(True).alias("_moved")),
        [F.col(f"{ref}.{c}") == F.col(f"_m_{c}") for c in ("index", "type", "id")], "left")
    was_moved = F.coalesce("_moved", F.lit(False))
    top, _, inner = ref.partition(".")
    target = F.col(top).withField(f"{inner}.index" if inner else "index", F.lit(dest))
    rows = flagged.withColumns({top: F.when(was_moved, target).otherwise(F.col(top)),
                                "_version": F.col("_version") + was_moved.cast("int")})
    changed = flagged.filter(was_moved).select(*KEY)
    return rows.select(*df.columns), changed


def repoint_external_array(df: DataFrame, array: str, uid: str, moved: DataFrame, dest: str) -> DataFrame:
    """Same for references held in an array of objects.

    Only references are exploded and joined; the moved ids come back per row and
    rewrite the array in place. Rows without a moved reference do not change.
    """
    refs = df.select(*KEY, F.explode(F.col(array)).alias("e")).select(*KEY, F.col(f"e.{uid}").alias("u"))
    hits = (refs.join(moved, [F.col(f"u.{c}") == moved[c] for c in ("index", "type", "id")], "left_semi")
            .groupBy(*KEY).agg(F.collect_set(F.struct("u.index", "u.type", "u.id")).alias("_hit")))
    joined = df.join(hits, KEY, "left")

    def move(e: Column) -> Column:
        u = e[uid]
        hit = F.exists("_hit", lambda h: (h["index"] == u["index"]) & (h["type"] == u["type"]) & (h["id"] == u["id"]))
        return F.when(hit, e.withField(f"{uid}.index", F.lit(dest))).otherwise(e)

    touched = F.col("_hit").isNotNull()
    return joined.withColumns({array: F.when(touched, F.transform(array, move)).otherwise(F.col(array)),
                               "_version": F.col("_version") + touched.cast("int")}).select(*df.columns)


NO_REFS = "array<struct<index:string,type:string,id:string>>"


def _gather(value: Column, dtype: T.DataType, name: str) -> Column | None:
    """All references inside a value as one array; None when its type has none."""
    if isinstance(dtype, T.ArrayType):
        if _gather(F.lit(None), dtype.elementType, name) is None:
            return None
        return F.coalesce(F.flatten(F.transform(value, lambda e: _gather(e, dtype.elementType, name))), F.array().cast(NO_REFS))
    if not isinstance(dtype, T.StructType):
        return None
    if name == "uid" and _is_uid(dtype):
        one = F.struct(*[value[c].cast("string").alias(c) for c in ("index", "type", "id")])
        return F.when(value.isNotNull(), F.array(one)).otherwise(F.array().cast(NO_REFS))
    parts = [p for f in dtype.fields if (p := _gather(value[f.name], f.dataType, f.name)) is not None]
    return F.concat(*parts) if parts else None


def repoint_everywhere(df: DataFrame, moved: DataFrame, dest: str) -> tuple[DataFrame, DataFrame]:
    """References to moved documents, wherever the schema holds one; ``(rows, changed ids)``.

    Paths are found in the schema, at any depth and inside arrays. Only keys and
    references are exploded and met with ``moved(index, type, id)`` in an equi-join; what
    was hit comes back per row. Changed rows get version + 1.
    """
    found = [p for f in df.schema.fields if (p := _gather(F.col(f.name), f.dataType, f.name)) is not None]
    if not found:
        return df, df.select(*KEY).filter(F.lit(False))
    refs = df.select(*KEY, F.explode(F.array_distinct(F.concat(*found))).alias("u")).select(*KEY, "u.*")
    hits = (refs.join(moved.select("index", "type", F.col("id").cast("string").alias("id")), ["index", "type", "id"], "left_semi")
            .groupBy(*KEY).agg(F.collect_set(F.struct("index", "type", "id")).alias("_hit")))

    def move(uid: Column) -> Column:
        hit = F.exists("_hit", lambda h: (h["index"] == uid["index"]) & (h["type"] == uid["type"]) & (h["id"] == uid["id"].cast("string")))
        return F.when(F.coalesce(hit, F.lit(False)), uid.withField("index", F.lit(dest))).otherwise(uid)

    rows = rewrite_refs(df.join(hits, KEY, "left"), move)
    rows = rows.withColumn("_version", F.col("_version") + F.col("_hit").isNotNull().cast("int"))
    return rows.select(*df.columns), hits.select(*KEY)


def reindex(source: DataFrame, dest: str, existing: DataFrame | None = None,
            transform: Callable[[DataFrame], DataFrame] | None = None,
            repoint: bool = True, old_indices: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Copy documents into the index ``dest``: ``(rows, moved uids, conflicts)``.

    The transform runs first. Versions are kept; where the destination already
    has the document, the higher version stays and an equal or lower source
    version is a conflict. Old index names are read from the data when not given.
    """
    moved = source.select(F.col("_index").alias("index"), F.col("_type").alias("type"), F.col("_id").alias("id"))
    rows = source.transform(transform) if transform is not None else source
    if repoint:
        if old_indices is None:
            # a handful by nature: one directory each
            old_indices = [r[0] for r in source.select("_index").distinct().collect()]
        rows = repoint_internal(rows, old_indices, dest)
    rows = rows.withColumn("_index", F.lit(dest))
    if existing is None:
        none = rows.select(*KEY, F.col("_version").alias("source_version"), F.col("_version").alias("dest_version"))
        return rows, moved, none.filter(F.lit(False))
    have = existing.select(*KEY, F.col("_version").alias("dest_version"))
    seen = rows.join(have, KEY, "left")
    newer = F.col("dest_version").isNull() | (F.col("_version") > F.col("dest_version"))
    written = seen.filter(newer).drop("dest_version")
    conflicts = seen.filter(~newer).select(*KEY, F.col("_version").alias("source_version"), "dest_version")
    kept = existing.join(written.select(*KEY), KEY, "left_anti")
    return kept.unionByName(written, allowMissingColumns=True), moved, conflicts


def by_period(df: DataFrame, field: str, period: str = "month") -> DataFrame:
    """Add ``_period``, the name of the time-based index a row belongs to."""
    layout = {"year": "yyyy", "month": "yyyy_MM", "day": "yyyy_MM_dd"}[period]
    return df.withColumn("_period", F.date_format(F.col(field).cast("timestamp"), layout))
