"""Generated location records, the same for any number of partitions.

Every value is cut from one SHA-256 of the row's index, so a row depends on its index and
the seed alone: no ``rand()``, which would change with the partitioning and with retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import (
    bits,
    date_from,
    digest,
    hex_draw,
    id_text,
    month_text,
    named,
    pick,
)

# The words of the dataset, the first ids and the year of the dates.
CATEGORIES = (
    "continents", "islands", "countries", "regions", "state", "cities", "neighborhoods", "villages",
)
GRANULARITIES = ("urban", "rural", "suburban")
SOURCES = ("A", "B", "C", "D", "E", "F", "G", "H")
FIRST_ADVERTISING_ID = 1
FIRST_USER_ID = 5000
FIRST_DATE = "2022-01-01"
DAYS = 365

# Our own short lists.
CITIES = (
    "Alderport", "Brightwater", "Cedarfield", "Dunmouth", "Eastmere", "Foxhollow",
    "Graniteford", "Harborview", "Ironbridge", "Juniper Bay", "Kingsreach", "Lakehaven",
)
STATES = ("Alaska", "Colorado", "Georgia", "Idaho", "Maine", "Nevada", "Ohio", "Oregon", "Texas", "Utah")

# Coordinates as in the dataset: latitude in steps of half a millionth of a degree.
STEPS = 360_000_001
HALF_STEPS = 180_000_000
# Moments between 1970 and late 2023, in seconds.
SECONDS = 1_700_000_000


def actives(spark: SparkSession, rows: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """``rows`` records, ids counted from the first."""
    index = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    return actives_for(index, "id", seed)


def actives_for(index: DataFrame, column: str, seed: int = 0) -> DataFrame:
    """One record per row of ``index``, whose ``column`` holds counted whole numbers from 0."""
    number, hex_digits = F.col("index"), F.col("hex")
    one, two, three = F.col("one"), F.col("two"), F.col("three")
    date = date_from(bits(three, 40, 20), FIRST_DATE, DAYS)
    return (
        index.select(named(column).cast("bigint").alias("index"))
        .withColumn("hex", digest(F.concat_ws(":", F.lit(str(seed)), number.cast("string"))))
        # Three numbers of 60 bits, cut once from the hash and then into the single draws.
        .select(
            "index",
            hex_draw(hex_digits, 1, 15).alias("one"),
            hex_draw(hex_digits, 16, 15).alias("two"),
            hex_draw(hex_digits, 31, 15).alias("three"),
        )
        .select(
            id_text(number, FIRST_ADVERTISING_ID).alias("advertising_id"),
            pick(bits(two, 32, 14), CITIES).alias("city"),
            pick(bits(three, 0, 10), CATEGORIES).alias("location_category"),
            pick(bits(three, 10, 10), GRANULARITIES).alias("location_granularities"),
            F.array(
                pick(bits(three, 20, 10), SOURCES), pick(bits(three, 30, 10), SOURCES)
            ).alias("location_source"),
            pick(bits(two, 46, 14), STATES).alias("state"),
            (F.pmod(bits(two, 0, 32), F.lit(SECONDS)) * F.lit(1_000_000_000)).alias("timestamp"),
            id_text(number, FIRST_USER_ID).alias("user_id"),
            (_centred(bits(one, 0, 30)) / F.lit(2_000_000.0)).alias("user_latitude"),
            (_centred(bits(one, 30, 30)) / F.lit(1_000_000.0)).alias("user_longitude"),
            date.alias("date"),
            month_text(date).alias("month"),
        )
    )


def _centred(draw: Column) -> Column:
    return (F.pmod(draw, F.lit(STEPS)) - F.lit(HALF_STEPS)).cast("double")
