"""Impression and completion counts per group."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourboard.operators.signage import DeviceHours, listing_weight, open_weight
from hourboard.schemas import KEYS


def count_by_minute(plays: DataFrame) -> DataFrame:
    """Equal keys and minute merged into one row, ahead of a shuffled join."""
    return plays.groupBy(*KEYS, "minute").agg(F.count(F.lit(1)).alias("plays"))


def count_groups(joined: DataFrame, devices: DeviceHours) -> DataFrame:
    """``imp`` (plays in opening hours) and ``cnt`` (all plays) per group, in one pass.

    Where the join has dealt the plays by device and salt, the groups are counted as they lie.
    """
    dealt = ["salt"] if "salt" in joined.columns else []
    times = F.col("plays") if "plays" in joined.columns else F.lit(1)
    weighted = joined.select(
        *KEYS,
        *dealt,
        (open_weight(devices) * times).cast("bigint").alias("imp"),
        (listing_weight() * times).cast("bigint").alias("cnt"),
    )
    sums = weighted.groupBy(*KEYS, *dealt).agg(F.sum("imp").alias("imp"), F.sum("cnt").alias("cnt"))
    return sums.drop(*dealt)


def with_impressions(counts: DataFrame) -> DataFrame:
    """Groups with at least one impression. Their ``cnt`` includes plays out of hours."""
    return counts.where(F.col("imp") > 0)
