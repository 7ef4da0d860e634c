from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """The top-level column of exactly this name, also when it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def digest(column: Column) -> Column:
    """SHA-256 of the value's text, as 64 lower-case hex digits; null stays null.

    The step over string matters: ANSI mode refuses to cast numbers to binary.
    """
    return F.sha2(column.cast("string").cast("binary"), 256)


def keyed_digest(column: Column, inner: Column, outer: Column) -> Column:
    """HMAC-SHA-256 of the value's text, the key given by ``hmac_pads``; null stays null."""
    first = F.sha2(F.concat(inner, column.cast("string").cast("binary")), 256)
    return F.sha2(F.concat(outer, F.unhex(first)), 256)


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """The inner and the outer block of HMAC-SHA-256 for a key."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(x ^ 0x36 for x in block), bytes(x ^ 0x5C for x in block)


def convert(
    column: Column,
    to: str,
    strict: bool = False,
    label: str = "value",
    dtype: T.DataType | None = None,
) -> Column:
    """Cast to any DDL type. What does not fit becomes null, or an error when strict.

    Both outcomes are independent of the session's ANSI setting. Give the column's ``dtype``
    if it is known: numbers far beyond a decimal's range are then sorted out by a comparison,
    as each failing ``try_cast`` costs an exception.
    """
    value = column.try_cast(to)
    bound = _decimal_bound(to) if isinstance(dtype, T.NumericType) else None
    if bound is not None:
        value = F.when((column < bound) & (column > -bound), value)
    if not strict:
        return value
    message = F.concat(
        F.lit(f"{label}: cannot convert "), column.cast("string"), F.lit(f" to {to}")
    )
    lost = column.isNotNull() & value.isNull()
    return F.when(lost, F.raise_error(message)).otherwise(value)


def _decimal_bound(to: str) -> int | None:
    """The power of ten that no value of the decimal type reaches, if a bigint can hold it."""
    target = T.DataType.fromDDL(to)
    if not isinstance(target, T.DecimalType) or target.precision - target.scale > 18:
        return None
    return 10 ** (target.precision - target.scale)


def delimited(column: Column, separator: str, dtype: T.DataType) -> Column:
    """Elements of an array joined by ``separator``.

    Null elements are skipped; a null and an empty array both give ``''``. Nothing is quoted.
    """
    if isinstance(dtype, T.ArrayType):
        if not isinstance(dtype.elementType, T.StringType):
            column = column.cast("array<string>")
    elif not isinstance(dtype, T.StringType):
        column = column.cast("string")
    return F.concat_ws(separator, column)


def month_text(date: Column) -> Column:
    """Month number as text without padding: '2', '11'."""
    return F.month(date).cast("string")


def epoch_nanos(timestamp_ntz: Column) -> Column:
    """Nanoseconds since 1970 of a timestamp without zone, whatever the session zone."""
    since = timestamp_ntz - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = since.cast("interval second").cast("decimal(18,6)")
    return (seconds * 1000000).cast("bigint") * F.lit(1000)


def id_text(index: Column, first: int) -> Column:
    """Sequential id as text; index 0 gives ``first``."""
    return (index + F.lit(first)).cast("string")


def hex_draw(hex_digits: Column, start: int, width: int) -> Column:
    """A non-negative bigint from ``width`` hex digits, counted from 1."""
    return F.conv(F.substring(hex_digits, start, width), 16, 10).cast("bigint")


def bits(number: Column, low: int, width: int) -> Column:
    """``width`` bits of a bigint, from bit ``low`` on."""
    return F.shiftright(number, low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def pick(draw: Column, words: Sequence[str]) -> Column:
    """One of ``words``, chosen by a non-negative draw."""
    index = F.pmod(draw, F.lit(len(words))) + 1
    return F.element_at(F.array(*[F.lit(word) for word in words]), index.cast("int"))


def date_from(draw: Column, first: str, days: int) -> Column:
    """One of ``days`` consecutive dates from ``first`` on, chosen by a non-negative draw."""
    offset = F.pmod(draw, F.lit(days)).cast("int")
    return F.date_add(F.lit(first).cast("date"), offset)
