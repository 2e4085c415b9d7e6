"""Conversions of single values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts accepted without an explicit format, and the
# integer ranges of the numeric widths.
DATE_FORMATS = ["yyyy/MM/dd HH:mm:ss Z", "yyyy/MM/dd Z", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd"]
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
NUMERIC = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint",
           "float": "float", "double": "double"}


def to_boolean(value: Column, nullable: bool = False) -> Column:
    """``0``, empty and ``false`` are false, all else true.

    Null is false, or stays null for a nullable boolean.
    """
    out = ~F.lower(value.cast("string")).isin("", "0", "0.0", "false")
    return out if nullable else F.coalesce(out, F.lit(False))


def to_date(value: Column, fmt: str | None = None) -> Column:
    """Timestamp from epoch milliseconds, ISO-8601 or the slash layouts."""
    text = value.cast("string")
    if fmt:
        return F.try_to_timestamp(text, F.lit(fmt))
    return F.coalesce(
        F.when(text.rlike(r"^-?\d+$"), F.timestamp_millis(text.try_cast("bigint"))),
        *[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS],
        text.try_cast("timestamp"),
    )


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, ISO_OUT)


def timestamp_to_millis(seconds: Column) -> Column:
    return F.floor(seconds * 1000 + 0.5).cast("long")


def millis_to_timestamp(millis: Column) -> Column:
    return F.round(millis / 1000, 3)


def encode_binary(value: Column) -> Column:
    """Base64 in lines of at most 76 characters, each ended by a newline."""
    one_line = F.replace(F.base64(value.cast("binary")), F.lit("\r\n"), F.lit(""))
    return F.when(F.length(one_line) == 0, F.lit("")).otherwise(
        F.regexp_replace(one_line, "(.{1,76})", "$1\n"))


def decode_binary(text: Column) -> Column:
    return F.unbase64(F.regexp_replace(text, r"\s", ""))


def ip_to_long(ip: Column) -> Column:
    """Number of a dotted IPv4 address; null when it is malformed."""
    octets = F.transform(F.split(ip, r"\."), lambda o: o.try_cast("long"))
    valid = ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & F.forall(octets, lambda o: o.between(0, 255))
    number = octets[0] * 2**24 + octets[1] * 2**16 + octets[2] * 2**8 + octets[3]
    return F.when(valid, number)


def to_numeric(value: Column, width: str) -> Column:
    """Range-checked cast to a numeric width; null when it does not fit."""
    if width not in NUMERIC:
        raise ValueError(f"unknown numeric width '{width}'")
    return value.try_cast(NUMERIC[width])


def null_value(value: Column, default) -> Column:
    """The searched form of a field: ``default`` where the value is null."""
    return F.coalesce(value, F.lit(default))


def tuple_to_object(value: Column, size: int) -> Column:
    return F.struct(*[F.get(value, F.lit(i)).alias(str(i)) for i in range(size)])


def object_to_tuple(value: Column, size: int) -> Column:
    return F.array(*[value.getField(str(i)) for i in range(size)])


def uid_key(type_: Column, id_: Column) -> Column:
    """``type;id`` with every inner semicolon doubled."""
    return F.concat_ws(";", *[F.replace(c.cast("string"), F.lit(";"), F.lit(";;"))
                              for c in (type_, id_)])


def convert(value: Column, fn) -> Column:
    """User conversion of one field: any Column function, or a pandas UDF."""
    return fn(value)
