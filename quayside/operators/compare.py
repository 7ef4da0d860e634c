"""Bag comparison of two frames; neither is ever brought to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import named

ONLY_ACTUAL = "only_in_actual"
ONLY_EXPECTED = "only_in_expected"

# Copies of a row that one step may hold as a list.
PIECE = 65536


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without those of ``right``, copies counted: {1,1,2} - {1} = {1,2}.

    Spark's own ``exceptAll`` writes all copies of a row as one list in memory, which a row
    repeated without bound does not survive; here they are made in pieces.
    """
    side, copies = _free_names(left, "side", "copies")
    surplus = _difference(left, right, side, copies).where(named(side) == ONLY_ACTUAL)
    return _repeated(surplus.drop(named(side)), copies)


def bag_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Both directions of the bag difference in one pass: the row, its side, surplus copies.

    Equal rows are counted on the map side first, so a row repeated very often costs one
    record per map task, and it leaves as one record however many its copies are. The frames
    may have no columns ``side`` and ``copies``, in whatever case; all other names are free.
    """
    clash = sorted(name for name in actual.columns if name.lower() in ("side", "copies"))
    if clash:
        raise ValueError(f"columns {clash} would stand beside the difference's own side and copies")
    return _difference(actual, expected, "side", "copies")


def _difference(actual: DataFrame, expected: DataFrame, side: str, copies: str) -> DataFrame:
    columns = [named(name) for name in actual.columns]
    (balance,) = _free_names(actual, "balance")
    net = named(balance)
    return (
        _balanced(actual, expected, balance)
        .groupBy(*columns)
        .agg(F.sum(net).alias(balance))
        .where(net != 0)
        .select(
            *columns,
            F.when(net > 0, ONLY_ACTUAL).otherwise(ONLY_EXPECTED).alias(side),
            F.abs(net).alias(copies),
        )
    )


def _free_names(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of the frame has, in whatever case."""
    taken = {name.lower() for name in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def golden_verdict(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: surplus copies on either side, and ``passed`` if there are none."""
    copies = F.col("copies")
    surplus = bag_difference(actual, expected).agg(
        F.coalesce(F.sum(F.when(F.col("side") == ONLY_ACTUAL, copies)), F.lit(0)).alias(ONLY_ACTUAL),
        F.coalesce(F.sum(F.when(F.col("side") == ONLY_EXPECTED, copies)), F.lit(0)).alias(ONLY_EXPECTED),
    )
    passed = (F.col(ONLY_ACTUAL) == 0) & (F.col(ONLY_EXPECTED) == 0)
    return surplus.withColumn("passed", passed)


def golden_verdicts(actual: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A verdict for each value of ``keys`` on either side, nulls among them, and its actual ``rows``.

    One comparison of all rows, however many values there are.
    """
    names = ("balance_of_row", "actual_of_row")
    net, there = names
    rows = _balanced(actual, expected, net).withColumn(there, F.when(named(net) > 0, 1).otherwise(0))
    each = rows.groupBy(*[named(name) for name in actual.columns]).agg(*[F.sum(name).alias(name) for name in names])
    surplus = named(net)
    verdicts = each.groupBy(*[named(key) for key in keys]).agg(
        F.sum(F.greatest(surplus, F.lit(0))).alias(ONLY_ACTUAL),
        F.sum(F.greatest(-surplus, F.lit(0))).alias(ONLY_EXPECTED),
        F.sum(there).alias("rows"),
    )
    passed = (F.col(ONLY_ACTUAL) == 0) & (F.col(ONLY_EXPECTED) == 0)
    return verdicts.withColumn("passed", passed)


def _repeated(df: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its column ``copies`` says; the column leaves.

    A row of few copies is written out where it is. One of many is cut into pieces of bounded
    copies, and these are spread over the tasks first: no task holds or emits all copies of a
    row. The number of tasks is given, as adaptive execution would merge the pieces, which are
    small until written out.
    """
    columns = [named(name) for name in df.columns if name != copies]
    piece_name, copy_name = _free_names(df, "piece", "copy")
    number, piece = named(copies), named(piece_name)

    def written(rows: DataFrame, held: Column) -> DataFrame:
        each = F.explode(F.sequence(F.lit(1).cast("bigint"), held)).alias(copy_name)
        return rows.select(*columns, each).select(*columns)

    few = written(df.where(number <= PIECE), number)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.floor((number - 1) / PIECE)
    many = df.where(number > PIECE)
    pieces = many.withColumn(piece_name, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    held = F.least(F.lit(PIECE).cast("bigint"), number - piece * PIECE)
    return few.union(written(pieces.repartition(tasks, *columns, piece), held))


def _balanced(actual: DataFrame, expected: DataFrame, balance: str) -> DataFrame:
    plus = actual.select("*", F.lit(1).cast("bigint").alias(balance))
    minus = aligned(expected, actual).select("*", F.lit(-1).cast("bigint").alias(balance))
    return plus.union(minus)


def aligned(other: DataFrame, model: DataFrame) -> DataFrame:
    """``other`` in the column order of ``model``; names and types must be the same."""
    types = {field.name: field.dataType for field in other.schema}
    wanted = {field.name: field.dataType for field in model.schema}
    unequal = [
        f"{name}: {_type(wanted, name)} against {_type(types, name)}"
        for name in dict.fromkeys([*wanted, *types])
        if _type(wanted, name) != _type(types, name)
    ]
    if unequal:
        raise TypeError("frames differ in their columns: " + "; ".join(unequal))
    return other.select(*[named(name) for name in model.columns])


def _type(types: dict, name: str) -> str:
    return types[name].simpleString() if name in types else "absent"
