"""Personal data in text columns: hits per column and pattern, in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named

# Patterns that all common regular expression engines read alike.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+",
    "ipv4": r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}",
    "phone": r"[+][0-9]{1,3} ?[(]?[0-9]{2,4}[)]?[ -]?[0-9]{3}[ -]?[0-9]{4}",
    "card": r"[0-9]{13,16}",
}

#: Forms with the same matches that Java's engine finds in one walk over the text, and a text that every
#: match holds. A local part can only begin where the last match ended or where no such character stands
#: before; it and the domain's labels are taken whole, one character at a time, so that nothing is tried
#: twice and no group is nested on the stack.
_LINEAR = {
    PATTERNS["email"]: (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++[.][A-Za-z0-9-]"
        r"(?:(?![.](?![A-Za-z0-9-]))[A-Za-z0-9.-])*+",
        "@",
    ),
    PATTERNS["phone"]: (PATTERNS["phone"], "+"),
    PATTERNS["ipv4"]: (PATTERNS["ipv4"], "."),
}

#: Detectors whose hits are checked: what may be one, and the check of its text.
CHECKED = {
    "card": (r"[0-9]{13,16}", lambda hit: luhn(hit)),
    "iban": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", lambda hit: mod_97(hit)),
    "ipv4": (PATTERNS["ipv4"], lambda hit: octets(hit)),
}


def pii_scan(
    df: DataFrame, columns: Sequence[str] | None = None, patterns: Mapping[str, str] = PATTERNS
) -> DataFrame:
    """(column, pattern, rows, hits): rows with a hit, and hits, of each pattern in each column.

    ``columns`` defaults to all text columns. One aggregate over all of them; nulls hold nothing.
    A hit is a candidate for masking, not a proof. The patterns above take time in proportion to a
    text's length, however odd it is; those of others are run as they are given.
    """
    return _summed(df, columns, {name: _count(regex) for name, regex in patterns.items()})


def pii_validated(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """As ``pii_scan``, for hits that pass a check: card numbers whose last digit is right by Luhn's rule,
    account numbers with the remainder 1 modulo 97, addresses of four octets.

    Digits inside longer runs are cut into pieces of up to 16, as the pattern finds them.
    """

    def count(regex: str, check) -> object:
        def of(text: Column) -> Column:
            hits = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
            return F.coalesce(F.size(F.filter(hits, check)), F.lit(0))

        return of

    return _summed(df, columns, {name: count(regex, check) for name, (regex, check) in CHECKED.items()})


def luhn(digits: Column) -> Column:
    """Whether the digits of a text, every second from the right doubled and summed by digit, give a multiple of 10."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda digit, place: F.element_at(
            F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), digit.cast("int") + 1
        )
        * (place % 2)
        + digit.cast("int") * (1 - place % 2),
    )
    return F.aggregate(places, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number, its first four signs put last and letters read as 10 to 35, is 1 modulo 97."""
    signs = F.split(F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4)), "")

    def next_remainder(rest: Column, sign: Column) -> Column:
        value = F.when(sign.between("0", "9"), F.ascii(sign) - 48).otherwise(F.ascii(sign) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(signs, F.lit(0), next_remainder) == 1


def octets(address: Column) -> Column:
    """Whether all four numbers of an address are at most 255."""
    return F.forall(F.split(address, "[.]"), lambda part: part.cast("int") <= 255)


def _count(regex: str):
    linear, sign = _LINEAR.get(regex, (regex, None))

    def of(text: Column) -> Column:
        hits = F.coalesce(F.regexp_count(text, F.lit(linear)), F.lit(0))
        return F.when(text.contains(sign), hits).otherwise(0) if sign else hits

    return of


def _summed(df: DataFrame, columns: Sequence[str] | None, counts: Mapping[str, object]) -> DataFrame:
    """Rows with a hit, and hits, of each count in each column; every text is searched once for it."""
    if columns is None:
        columns = [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]
    found = {f"hits_{k}": (c, n) for k, (c, n) in enumerate((c, n) for c in columns for n in counts)}
    if not found:
        return df.sparkSession.createDataFrame([], "column string, pattern string, rows long, hits long")
    # Both sums of a count are of one column, so that it is evaluated once.
    hits = df.select(*[counts[name](named(column)).alias(key) for key, (column, name) in found.items()])
    sums = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(name).alias("pattern"),
            F.count_if(F.col(key) > 0).alias("rows"),
            F.coalesce(F.sum(key), F.lit(0)).alias("hits"),
        )
        for key, (column, name) in found.items()
    ]
    return hits.agg(F.array(*sums).alias("found")).select(F.inline("found"))
