"""Columns of a dimension beside the rows of a fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import named

#: Items that the summary of frequent keys tracks, at a power of two.
TRACKED = 4096


def enrich_join(
    fact: DataFrame, dimension: DataFrame, keys: Mapping[str, str], columns: Sequence[str]
) -> DataFrame:
    """Left join of ``columns`` of a dimension by keys, given as fact column to dimension column.

    Every fact row stays once per match; a null key matches nothing. No broadcast is asked for:
    Spark sends the dimension round if its own size rule allows, and else splits keys that hold a
    large share of the fact's rows (``spark.sql.adaptive.skewJoin.enabled``).
    """
    clash = sorted({name.lower() for name in columns} & {name.lower() for name in fact.columns})
    if clash:
        raise ValueError(f"the fact has columns of these names already: {clash}")
    ours = {of: f"key_{place}_of_dimension" for place, of in enumerate(keys.values())}
    side = dimension.select(
        *[named(of).alias(name) for of, name in ours.items()], *[named(name) for name in columns]
    )
    same = [named(key) == named(ours[of]) for key, of in keys.items()]
    return fact.join(side, same, "left").drop(*ours.values())


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float, tracked: int = TRACKED) -> dict[int, int]:
    """Hashes of keys that hold about ``share`` of the rows or more, with upper estimates of their rows.

    One pass. Each task keeps a summary of at most ``tracked`` items, and the summaries are merged, so
    memory does not grow with the number of keys. A summary's error is below 4 rows in ``tracked``: no
    key with a greater share is missed, and ``share`` must be greater. Null keys match nothing and are
    left out.
    """
    if share * tracked <= 4:
        raise ValueError(f"a summary of {tracked} items cannot tell shares of {share}")
    rows = df.where(~_any_null(keys)).select(_hash(keys).alias("key"))
    most = max(1, min(tracked - 1, int(2 / share) + 1))
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {most}, {tracked})").alias("top")).first()
    return {item["item"]: item["count"] for item in found["top"] or () if item["count"] >= share * found["rows"]}


def _hash(keys: Sequence[str]):
    return F.xxhash64(*[named(key) for key in keys])


def _any_null(keys: Sequence[str]):
    found = F.lit(False)
    for key in keys:
        found = found | named(key).isNull()
    return found


def enrich_skewed(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Mapping[str, str],
    columns: Sequence[str],
    *,
    tasks: int | None = None,
    tracked: int = TRACKED,
) -> DataFrame:
    """``enrich_join`` for facts of which a few keys have a large share, where the dimension is too large to send round.

    Keys with more than half a task's rows, ``tasks`` being the shuffle's partitions, are found by
    ``frequent_keys``. Their fact rows are dealt to as many salts as fill half a task each, and the rows of
    the dimension that match them are repeated once for every salt. All other rows have one salt. So no
    task gets much more than its share, whatever adaptive execution does. Fact rows of a null key are dealt
    out too, as they match nothing. The same rows come out as of ``enrich_join``.
    """
    spark = fact.sparkSession
    clash = sorted({name.lower() for name in columns} & {name.lower() for name in fact.columns})
    if clash:
        raise ValueError(f"the fact has columns of these names already: {clash}")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(0.5 / tasks, 8 / tracked)
    hot = frequent_keys(fact, list(keys), share, tracked)
    rows = sum(hot.values())
    total = fact.count() if hot else 0
    # Rows that one salt may have; as the estimates are upper ones, salts are rather too many.
    lines = [(key, max(2, round(count / max(1.0, share * total)))) for key, count in hot.items()]
    # At most tracked lines.
    salts = F.broadcast(spark.createDataFrame(lines if rows else [], "hash_of_hot_key long, salts_of_key int"))
    number, salt = F.monotonically_increasing_id(), "salt_of_row"
    marked = fact.withColumn("hash_of_row", _hash(list(keys)))
    marked = marked.join(salts, F.col("hash_of_row") == F.col("hash_of_hot_key"), "left")
    spread = F.coalesce(F.when(_any_null(list(keys)), F.lit(tasks)), F.col("salts_of_key"), F.lit(1))
    marked = marked.withColumn(salt, F.pmod(number, spread).cast("int")).drop("hash_of_row", "hash_of_hot_key", "salts_of_key")
    ours = {of: f"key_{place}_of_dimension" for place, of in enumerate(keys.values())}
    side = dimension.select(
        *[named(of).alias(name) for of, name in ours.items()], *[named(name) for name in columns]
    )
    side = side.join(salts, _hash(list(ours.values())) == F.col("hash_of_hot_key"), "left")
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts_of_key"), F.lit(1)) - 1)).alias("salt_of_dimension")
    side = side.select(*ours.values(), *[named(name) for name in columns], repeated)
    same = [named(key) == named(ours[of]) for key, of in keys.items()]
    joined = marked.join(side, [*same, named(salt) == F.col("salt_of_dimension")], "left")
    return joined.drop(*ours.values(), "salt_of_dimension", salt)
