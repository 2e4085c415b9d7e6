"""Unscored filters: functions that return a boolean Column.

Conventions. An array of operands means OR. A null operand means "missing". On a
multi-valued field (``many=True``) a predicate holds when any element satisfies
it. Positive filters are plain comparisons, which the Parquet scan can use to skip
row groups; they may be null on rows without a value, which a filter drops. A
``not_`` form accepts such rows, so ``negate`` takes null as false first.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.functions import geo

Predicate = Callable[[Column], Column]


def _col(field: str | Column) -> Column:
    return F.col(field) if isinstance(field, str) else field


def _any(field: str | Column, predicate: Predicate, many: bool) -> Column:
    c = _col(field)
    return F.exists(c, predicate) if many else predicate(c)


def _as_list(values) -> list:
    return list(values) if isinstance(values, (list, tuple, set)) else [values]


def negate(predicate: Column) -> Column:
    return ~F.coalesce(predicate, F.lit(False))


# --- presence ---------------------------------------------------------------

def exists(field, many: bool = False) -> Column:
    c = _col(field)
    return c.isNotNull() & (F.size(F.array_compact(c)) > 0) if many else c.isNotNull()


def missing(field, many: bool = False, null_value=None, existence: bool = True) -> Column:
    """No value; with ``null_value`` a row holding that stand-in counts too.

    Without ``existence`` only the stand-in counts.
    """
    if not existence and null_value is None:
        raise ValueError("missing needs existence or a null value")
    absent = ~exists(field, many) if existence else F.lit(False)
    return absent if null_value is None else absent | F.coalesce(_any(field, lambda v: v == null_value, many), F.lit(False))


not_exists, not_missing = missing, exists


# --- exact values -----------------------------------------------------------

def _equals(value) -> Predicate:
    return lambda x: x == F.lit(value)


def term(field, value, many: bool = False) -> Column:
    return terms(field, value, many=many)


def terms(field, values, execution: str = "or", many: bool = False) -> Column:
    """One of ``values``, or all of them with ``execution="and"``.

    A null among the values, or no value at all, means "missing".
    """
    wanted = _as_list(values)
    present = [v for v in wanted if v is not None]
    tests = []
    if execution == "and":
        tests = [_any(field, _equals(v), many) for v in present]
    elif present:
        tests = [_any(field, lambda x: x.isin(present), many)]
    if len(present) < len(wanted) or not wanted:
        tests.append(missing(field, many))
    return reduce(operator.and_ if execution == "and" else operator.or_, tests)


def not_term(field, value, many: bool = False) -> Column:
    return negate(terms(field, value, many=many))


not_terms = not_term


def prefix(field, values, many: bool = False) -> Column:
    wanted = _as_list(values)
    if any(v is None for v in wanted):
        raise ValueError("prefix needs a value")
    return _any(field, lambda x: reduce(operator.or_, [x.startswith(v) for v in wanted]), many)


def not_prefix(field, values, many: bool = False) -> Column:
    return negate(prefix(field, values, many))


BOUNDS = {"gt": operator.gt, ">": operator.gt, "gte": operator.ge, ">=": operator.ge,
          "lt": operator.lt, "<": operator.lt, "lte": operator.le, "<=": operator.le}


def _meets(op: Callable, value: Column) -> Predicate:
    return lambda x: op(x, value)


def _bounds(pairs: Sequence[tuple[str, object]]) -> list[tuple[Callable, Column]]:
    seen, out = set(), []
    for name, value in pairs:
        if name not in BOUNDS:
            raise ValueError(f"unknown range operator '{name}'")
        if value is None:
            raise ValueError(f"range operator '{name}' needs a value")
        op = BOUNDS[name]
        if op in seen:
            raise ValueError(f"range operator '{name}' given twice")
        seen.add(op)
        out.append((op, value if isinstance(value, Column) else F.lit(value)))
    return out


def range_(field, *pairs: tuple[str, object], many: bool = False, flat: bool = False, **named) -> Column:
    """Range on text, dates or numbers.

    On a multi-valued field one element must meet all bounds; with ``flat`` each
    bound may be met by another element, as for flattened objects.
    """
    bounds = _bounds([*pairs, *named.items()])
    if many and flat:
        return reduce(operator.and_, [_any(field, _meets(o, v), True) for o, v in bounds])
    return _any(field, lambda x: reduce(operator.and_, [o(x, v) for o, v in bounds]), many)


def numeric_range(field, *pairs: tuple[str, object], many: bool = False) -> Column:
    """Range after a cast to double, for the symbol operators."""
    bounds = _bounds(pairs)
    return _any(field, lambda x: reduce(
        operator.and_, [o(x.try_cast("double"), v) for o, v in bounds]), many)


def not_range(field, *pairs, many: bool = False, **named) -> Column:
    return negate(range_(field, *pairs, many=many, **named))


# --- logic ------------------------------------------------------------------

def _operands(filters) -> list[Column]:
    """Columns from filters given one by one or as ``{field: value}`` mappings."""
    out = []
    for f in filters:
        if f is None:
            continue
        if isinstance(f, Mapping):
            out.extend(terms(k, v) for k, v in f.items())
        elif isinstance(f, Column):
            out.append(f)
        else:
            raise TypeError(f"not a filter: {f!r}")
    return out


def and_(*filters) -> Column:
    return reduce(operator.and_, _operands(filters), F.lit(True))


def or_(*filters) -> Column:
    operands = _operands(filters)
    return reduce(operator.or_, operands) if operands else F.lit(True)


def not_(filters) -> Column:
    """A mapping is NOT(AND), a list is NOT(OR), a single filter its negation."""
    if isinstance(filters, Column):
        return negate(filters)
    if not filters:
        return F.lit(True)
    return negate(and_(filters) if isinstance(filters, Mapping) else or_(*filters))


# --- geo --------------------------------------------------------------------

def geo_distance(field, lat: float, lon: float, distance) -> Column:
    limit = geo.metres(distance)
    p = _col(field)
    return geo.within_latitudes(p, lat, limit) & (geo.haversine(p, lat, lon) <= limit)


def geo_distance_range(field, lat: float, lon: float, *pairs, **named) -> Column:
    distance = geo.haversine(_col(field), lat, lon)
    return reduce(operator.and_, [BOUNDS[k](distance, geo.metres(v))
                                  for k, v in [*pairs, *named.items()]])


def geo_bounding_box(field, top_left: tuple[float, float], bottom_right: tuple[float, float]) -> Column:
    """Corners as ``(lat, lon)``; a left edge east of the right one wraps around."""
    (top, left), (bottom, right) = top_left, bottom_right
    p = _col(field)
    lon = p["lon"]
    inside = lon.between(left, right) if left <= right else (lon >= left) | (lon <= right)
    return p["lat"].between(bottom, top) & inside


geo_bbox = geo_bounding_box


def geo_polygon(field, points: list[tuple[float, float]]) -> Column:
    return geo.in_polygon(_col(field), points)


def not_geo_distance(field, *args) -> Column:
    return negate(geo_distance(field, *args))


def not_geo_distance_range(field, *args, **named) -> Column:
    return negate(geo_distance_range(field, *args, **named))


def not_geo_bounding_box(field, *args) -> Column:
    return negate(geo_bounding_box(field, *args))


def not_geo_polygon(field, points) -> Column:
    return negate(geo_polygon(field, points))


# --- document metadata ------------------------------------------------------

def ids(values, type_=None) -> Column:
    """Document id, and type when given. For id *tables* use ``ids_in``."""
    wanted = F.col("_id").isin([str(v) for v in _as_list(values)])
    return wanted if type_ is None else wanted & F.col("_type").isin(_as_list(type_))


def not_ids(values, type_=None) -> Column:
    return negate(ids(values, type_))


def ids_in(df: DataFrame, id_table: DataFrame, on: str | list[str] = "_id", negated: bool = False) -> DataFrame:
    """Keep the rows whose id is (not) in a table of any size."""
    return df.join(id_table, on, "left_anti" if negated else "left_semi")


def type_(values) -> Column:
    return F.col("_type").isin(_as_list(values))


def not_type(values) -> Column:
    return negate(type_(values))


def script(expression, **params) -> Column:
    """Any predicate: a Column function, or SQL text with ``:name`` parameters."""
    return script_value(expression, **params).cast("boolean")


def _sql_literal(value) -> str:
    if isinstance(value, bool) or value is None:
        return str(value).lower() if value is not None else "null"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def script_value(expression, **params) -> Column:
    """Computed value of a script: SQL text with ``:name`` parameters, or a
    function that gets the parameters as literal columns."""
    if callable(expression):
        return expression(**{k: F.lit(v) for k, v in params.items()})
    return F.expr(re.sub(r"(?<!:):([A-Za-z_]\w*)", lambda m: _sql_literal(params[m[1]]), expression))


def indices(names, predicate: Column, no_match="none") -> Column:
    """``predicate`` on rows of the named indices; else none, all or a filter."""
    other = {"none": F.lit(False), "all": F.lit(True)}.get(no_match) if isinstance(no_match, str) else no_match
    if other is None:
        raise ValueError("no_match is 'none', 'all' or a filter")
    return F.when(F.col("_index").isin(_as_list(names)), predicate).otherwise(other)


def nested(path, predicate: Predicate) -> Column:
    """All conditions on one element of an array of objects."""
    return _any(path, predicate, True)


def not_nested(path, predicate: Predicate) -> Column:
    return negate(nested(path, predicate))


def match_all() -> Column:
    return F.lit(True)


def matched_filters(**named: Column) -> Column:
    """Names of the filters a row satisfies, as an array column."""
    return F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in named.items()]))


def limit_per_shard(df: DataFrame, n: int, shard: str = "_shard", id_: str = "_id") -> DataFrame:
    """At most ``n`` rows of each shard, lowest ids first.

    The rank filter is applied inside each task before the shuffle (group limit),
    so a big shard never travels whole.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(shard).orderBy(id_)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


# --- references between documents -------------------------------------------

def _uid_equals(ref: Column, uid: Mapping) -> Column:
    for part in ("index", "type", "id"):
        if uid.get(part) is None:
            raise ValueError(f"reference lacks its {part}")
    return reduce(operator.and_, [ref[k] == uid[k] for k in ("index", "type", "id")])


def ref_is(field, uids) -> Column:
    """The reference equals the uid, or one of a short list of uids."""
    wanted = _as_list(uids)
    if not wanted:
        return missing(field)
    return reduce(operator.or_, [
        missing(field) if u is None else _uid_equals(_col(field), u) for u in wanted])


def not_ref(field, uids) -> Column:
    return negate(ref_is(field, uids))


def ref_in(df: DataFrame, field: str, uid_table: DataFrame, negated: bool = False) -> DataFrame:
    """Same against a table of uids ``(index, type, id)``."""
    condition = reduce(operator.and_, [F.col(f"{field}.{k}") == F.col(f"_u.{k}") for k in ("index", "type", "id")])
    return df.join(uid_table.alias("_u"), condition, "left_anti" if negated else "left_semi")
