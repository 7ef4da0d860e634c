"""Bag comparison by a tree of digests: rows are shuffled only where the two sides differ.

Every row has a digest of 128 bits, whose halves are summed over hash buckets, one side positive and the
other negative. A bucket in which the sums and the count are zero holds the same bag on both sides, but
for a chance of about 2^-128. Buckets that differ are cut into finer ones while that leaves out most of
their rows; the rows of the last ones are compared as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named
from quayside.operators.compare import ONLY_ACTUAL, ONLY_EXPECTED, aligned, bag_difference

#: Buckets of the first level, and most buckets of any.
FANOUT, MOST = 1 << 10, 1 << 17
#: Rows in differing buckets that are compared at once, without finer buckets.
FEW = 1 << 16
_BITS = FANOUT.bit_length() - 1


@dataclass(frozen=True)
class TreeDifference:
    #: As ``bag_difference`` returns it.
    rows: DataFrame
    #: For each level: buckets that differ, and rows of both sides in them.
    levels: tuple[tuple[int, int], ...]


def tree_difference(actual: DataFrame, expected: DataFrame, *, few: int = FEW) -> TreeDifference:
    """Both directions of the bag difference, equal to ``bag_difference``.

    Equal frames cost one scan and a shuffle of as many records as there are buckets and tasks; a few
    differing rows one or two scans more. Where most buckets differ, it is one scan more than comparing all.
    Both frames are scanned anew for each level, so they have to give the same rows every time.
    """
    expected = aligned(expected, actual)
    left, right = (_digested(df) for df in (actual, expected))
    levels: list[tuple[int, int]] = []
    differing, depth, before = None, 0, None
    while True:
        depth += 1
        found = _differing(left, right, differing, depth)
        rows = sum(row.rows for row in found)
        levels.append((len(found), rows))
        if not found:
            break
        # Finer buckets pay as long as they have left out half of the rows.
        fine = before is not None and 2 * rows > before
        differing = _numbers(actual, [row.bucket for row in found])
        if rows <= few or fine or len(found) * FANOUT > MOST or (depth + 1) * _BITS > 60:
            break
        before = rows
    if not levels[-1][0]:
        none = bag_difference(actual.limit(0), actual.limit(0))
        return TreeDifference(none, tuple(levels))
    kept = [_within(df, differing, depth).select([named(name) for name in actual.columns]) for df in (left, right)]
    return TreeDifference(bag_difference(*kept), tuple(levels))


def tree_verdict(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """One row, as ``golden_verdict`` returns it, by the tree."""
    copies, side = F.col("copies"), F.col("side")
    surplus = tree_difference(actual, expected).rows.agg(
        F.coalesce(F.sum(F.when(side == ONLY_ACTUAL, copies)), F.lit(0)).alias(ONLY_ACTUAL),
        F.coalesce(F.sum(F.when(side == ONLY_EXPECTED, copies)), F.lit(0)).alias(ONLY_EXPECTED),
    )
    return surplus.withColumn("passed", (F.col(ONLY_ACTUAL) == 0) & (F.col(ONLY_EXPECTED) == 0))


_ONE, _TWO = "digest_one_of_row", "digest_two_of_row"


def _digested(df: DataFrame) -> DataFrame:
    clash = {name.lower() for name in df.columns} & {_ONE, _TWO}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would stand beside the digests of the rows")
    values = [_hashable(named(f.name), f.dataType) for f in df.schema]
    # A hash passes over nulls, so which values are null is hashed first.
    nulls = [F.isnull(named(name)) for name in df.columns]
    return df.withColumns({_ONE: F.xxhash64(F.lit(1), *nulls, *values), _TWO: F.xxhash64(F.lit("two"), *nulls, *reversed(values))})


def _hashable(column: Column, dtype: T.DataType) -> Column:
    """The value, or its JSON text where nulls inside would be passed over."""
    if isinstance(dtype, T.AtomicType):
        return column
    return F.to_json(F.struct(column.alias("value")), {"ignoreNullFields": "false"})


def _bucket(depth: int) -> Column:
    """The number of a row's bucket: the low bits of its digest, more of them the deeper."""
    return F.col(_ONE).bitwiseAND(F.lit((1 << depth * _BITS) - 1).cast("long"))


def _within(df: DataFrame, differing: DataFrame | None, depth: int) -> DataFrame:
    """The rows in differing buckets of a level; their numbers are at most MOST, so all tasks get them."""
    if differing is None:
        return df
    marked = df.withColumn("bucket_of_row", _bucket(depth))
    return marked.join(F.broadcast(differing), F.col("bucket_of_row") == F.col("number_of_bucket"), "left_semi").drop("bucket_of_row")


def _numbers(df: DataFrame, numbers: list[int]) -> DataFrame:
    return df.sparkSession.createDataFrame([(x,) for x in numbers], "number_of_bucket long")


def _differing(left: DataFrame, right: DataFrame, differing: DataFrame | None, depth: int) -> list:
    """(bucket, rows) of the buckets of a level that differ, among those inside ``differing`` of the level above."""
    both = []
    for df, sign in ((left, 1), (right, -1)):
        inside = _within(df, differing, depth - 1)
        both.append(inside.select(_bucket(depth).alias("bucket"), F.col(_ONE).alias("one"), F.col(_TWO).alias("two"), F.lit(sign).alias("sign")))
    exact = [F.sum(F.col(name).cast("decimal(20,0)") * F.col("sign")).alias(name) for name in ("one", "two")]
    sums = both[0].unionAll(both[1]).groupBy("bucket").agg(*exact, F.sum("sign").alias("sign"), F.count(F.lit(1)).alias("rows"))
    return sums.where((F.col("one") != 0) | (F.col("two") != 0) | (F.col("sign") != 0)).select("bucket", "rows").collect()
