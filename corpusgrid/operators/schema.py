"""Schemas, projections and document shape."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = ["_index", "_type", "_id", "_version", "_routing", "_parent"]


def enforce_schema(df: DataFrame, schema: T.StructType, dynamic: str | bool = "strict",
                   now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast every field to its declared type; ``(accepted, rejected)``.

    A value that cannot be cast rejects the row, with the field names in
    ``_errors``. An undeclared field is an error (``"strict"``), is dropped
    (False) or kept with number and date detection (True).
    """
    declared = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in df.columns if c not in declared]
    if unknown and dynamic == "strict":
        raise ValueError(f"fields not in the schema: {unknown}")
    out, bad = [], []
    for name, dtype in declared.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(dtype).alias(name))
            continue
        cast = F.col(name).try_cast(dtype)
        out.append(cast.alias(name))
        bad.append(F.when(F.col(name).isNotNull() & cast.isNull(), F.lit(name)))
    if dynamic is True:
        out += [detect(df, c).alias(c) for c in unknown]
    if now is not None and "timestamp" not in df.columns:
        out = [c for c, f in zip(out, list(declared)) if f != "timestamp"] + out[len(declared):] + [now.alias("timestamp")]
    errors = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    marked = df.withColumn("_errors", errors)
    return (marked.filter(F.size("_errors") == 0).select(*out), marked.filter(F.size("_errors") > 0))


def detect(df: DataFrame, name: str) -> Column:
    """Undeclared text as ``struct<text,number,date>``: per-row detection."""
    text = F.col(name).cast("string")
    return F.struct(text.alias("text"), text.try_cast("double").alias("number"),
                    F.try_to_timestamp(text).alias("date"))


def all_field(df: DataFrame, include: list[str] | None = None, exclude: list[str] = (),
              name: str = "_all") -> DataFrame:
    """Concatenate the included fields; an excluded object excludes its children."""
    parts = []
    for path, dtype in leaves(df.schema):
        top = path.split(".")[0]
        if top in META or any(path == e or path.startswith(f"{e}.") for e in exclude):
            continue
        if include is not None and not any(path == i or path.startswith(f"{i}.") for i in include):
            continue
        value = F.col(path)
        parts.append(F.array_join(value.cast("array<string>"), " ") if isinstance(dtype, T.ArrayType)
                     else value.cast("string"))
    return df.withColumn(name, F.concat_ws(" ", *parts))


def leaves(schema: T.StructType, parent: str = "") -> list[tuple[str, T.DataType]]:
    """Dotted paths of all leaf fields; arrays of objects project through."""
    out = []
    for f in schema.fields:
        path, dtype = f"{parent}{f.name}", f.dataType
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if isinstance(inner, T.StructType):
            through = isinstance(dtype, T.ArrayType)
            out += [(p, T.ArrayType(t) if through else t) for p, t in leaves(inner, f"{path}.")]
        else:
            out.append((path, dtype))
    return out


def flatten_object(df: DataFrame, fields: list[str] | None = None, separator: str = ".") -> DataFrame:
    """Nested fields as dotted columns; an array of objects becomes parallel arrays."""
    chosen = [p for p, _ in leaves(df.schema)
              if fields is None or any(p == f or p.startswith(f"{f}.") for f in fields)]
    return df.select(*[F.col(p).alias(p.replace(".", separator)) for p in chosen])


def nested_field(df: DataFrame, field: str, include_in_parent: bool = False, include_in_root: bool = False) -> DataFrame:
    """Keep the objects apart for per-element matching, also flat when asked.

    ``include_in_parent`` copies the fields of the objects beside them;
    ``include_in_root`` also those of objects inside the objects, as one flat array per
    leaf at the top of the row.
    """
    flat = {}

    def walk(values: Column, element: T.StructType, path: str) -> None:
        for f in element.fields:
            inner = _each_field(values, f.name)
            many = isinstance(f.dataType, T.ArrayType)
            if many:
                inner = F.flatten(F.filter(inner, lambda x: x.isNotNull()))
            below = f.dataType.elementType if many else f.dataType
            if isinstance(below, T.StructType) and include_in_root:
                walk(inner, below, f"{path}__{f.name}")
            elif not many or include_in_root:
                flat[f"{path}__{f.name}"] = inner

    if include_in_parent or include_in_root:
        walk(F.col(field), df.schema[field].dataType.elementType, field)
    return df.withColumns(flat) if flat else df


def _each_field(values: Column, name: str) -> Column:
    return F.transform(values, lambda e: e[name])


def multi_field(df: DataFrame, field: str, subfields: dict) -> DataFrame:
    """Sub-fields derived from one value; the value itself is ``field__field`` too."""
    return df.withColumns({f"{field}__{field}": F.col(field),
                           **{f"{field}__{n}": fn(F.col(field)) for n, fn in subfields.items()}})


def uid_struct(index: Column, type_: Column, id_: Column, routing: Column | None = None) -> Column:
    return F.struct(index.alias("index"), type_.alias("type"), id_.cast("string").alias("id"),
                    (routing if routing is not None else F.lit(None)).cast("string").alias("routing"))


def embed(df: DataFrame, ref: DataFrame, on: str, ref_key: str, name: str, uid: Column,
          include_attrs: list[str] | None = None, exclude_attrs: list[str] = ()) -> DataFrame:
    """Denormalise a referenced document into the row: uid and chosen attributes.

    ``uid`` is computed on the referenced side. A row without a target gets null.
    """
    attrs = [c for c in (include_attrs if include_attrs is not None else ref.columns) if c not in exclude_attrs]
    packed = ref.select(F.col(ref_key).alias("_ref"),
                        F.struct(uid.alias("uid"), *[F.col(a) for a in attrs]).alias(name))
    return df.join(packed, df[on] == packed["_ref"], "left").drop("_ref")


def exclude(df: DataFrame, cols: list[str]) -> DataFrame:
    """Attributes that are not stored."""
    return df.drop(*cols)


def _compatible(old: T.DataType, new: T.DataType, path: str) -> None:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        for f in new.fields:
            if f.name in old.names:
                _compatible(old[f.name].dataType, f.dataType, f"{path}.{f.name}")
    elif isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        _compatible(old.elementType, new.elementType, path)
    elif old != new:
        raise ValueError(f"field {path} changed from {old.simpleString()} to {new.simpleString()}")


def append_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows that may bring new fields; a changed type is an error."""
    for f in new.schema.fields:
        if f.name in old.columns:
            _compatible(old.schema[f.name].dataType, f.dataType, f.name)
    return old.unionByName(new, allowMissingColumns=True)


def drop_type(df: DataFrame, type_: str) -> DataFrame:
    return df.filter(F.col("_type") != type_)


def _matches(path: str, patterns: list[str]) -> bool:
    parents = [".".join(path.split(".")[:i]) for i in range(1, path.count(".") + 2)]
    return any(fnmatch.fnmatchcase(p, pattern) for p in parents for pattern in patterns)


def _each_struct(values: Column, keep, element: T.StructType, path: str) -> Column:
    return F.transform(values, lambda e: F.struct(*keep(e, element, path)))


def source_filter(df: DataFrame, include: list[str] = ("*",), exclude: list[str] = ()) -> DataFrame:
    """Project nested fields by wildcard paths, also inside arrays of objects; the rows
    are marked partial.

    Only a schema walk: Parquet reads just the leaves that are left.
    """
    def keep(col: Column, dtype: T.StructType, parent: str) -> list[Column]:
        out = []
        for f in dtype.fields:
            path = f"{parent}{f.name}"
            value = col[f.name] if col is not None else F.col(f.name)
            many = isinstance(f.dataType, T.ArrayType)
            below = f.dataType.elementType if many else f.dataType
            if isinstance(below, T.StructType):
                inner = keep(value, below, f"{path}.")
                if inner and many:
                    out.append(_each_struct(value, keep, below, f"{path}.").alias(f.name))
                elif inner:
                    out.append(F.struct(*inner).alias(f.name))
            elif _matches(path, include) and not _matches(path, exclude):
                out.append(value.alias(f.name))
        return out

    meta = [F.col(c) for c in df.columns if c in META]
    body = T.StructType([f for f in df.schema.fields if f.name not in META])
    return df.select(*meta, *keep(None, body, ""), F.lit(True).alias("is_partial"))


def fields(df: DataFrame, names: list[str], key: str) -> DataFrame:
    """A list of fields instead of whole documents; every value as an array."""
    types = dict(leaves(df.schema))
    values = [F.col(n) if isinstance(types.get(n), T.ArrayType) else F.array(F.col(n)) for n in names]
    return df.select(key, *[v.alias(n) for v, n in zip(values, names)])


def script_fields(df: DataFrame, scripts: dict, **params) -> DataFrame:
    from corpusgrid.functions.filters import script_value
    return df.withColumns({n: script_value(e, **params) for n, e in scripts.items()})


def expire(df: DataFrame, ttl: str | dict[str, str], now: Column, field: str = "timestamp", type_: str = "_type") -> DataFrame:
    """Drop documents older than their time to live, given as an interval, or as one per
    type; types without one stay."""
    written = F.col(field).cast("timestamp")
    if isinstance(ttl, str):
        return df.filter(written + F.expr(f"INTERVAL {ttl}") > now)
    alive = F.lit(True)
    for name, interval in ttl.items():
        alive = F.when(F.col(type_) == name, written + F.expr(f"INTERVAL {interval}") > now).otherwise(alive)
    return df.filter(alive)
