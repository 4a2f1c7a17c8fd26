"""Opening hours per device, and their left join to plays.

The signage table may list a device several times, and every listing counts: a play of a device
with three listings makes three joined rows. Here the listings are folded into one row per device
that says how many there are and how many of them are open at a minute, so a play is weighted
instead of multiplied and a heavily repeated device costs no more than any other.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from hourboard.functions import hours
from hourboard.schemas import KEYS
from hourboard.scratch import scratch_path

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# Devices a sketch of the plays tracks, and how many busy ones it may name. It misses none that has more
# than one row in three quarters of those it tracks.
TRACKED_DEVICES = 4096
BUSY_DEVICES = 1024

# In-memory cost of a hashed row beyond its text, and of one per-minute array.
ROW_BYTES = 64
PER_MINUTE_BYTES = 8 * hours.MINUTES_PER_DAY


@dataclass(frozen=True)
class DeviceHours:
    """One row per device: ``device``, ``listings``, ``opens``, ``closes``, ``open_by_minute``.

    ``opens``/``closes`` are minute ranks. Where a device's listings disagree, ``open_by_minute``
    holds the number of open listings at each minute of the day and takes their place.
    """

    frame: DataFrame
    size_bytes: int
    default_opens: int
    default_closes: int


def device_hours(
    signage: DataFrame,
    default_opening: str = hours.DEFAULT_OPENING,
    default_closing: str = hours.DEFAULT_CLOSING,
) -> DeviceHours:
    """Fold the signage table. Runs one small job to learn the size of the outcome."""
    listings = signage.where(F.col("fully_device_id").isNotNull()).select(
        F.col("fully_device_id").alias("device"),
        hours.minute_rank(hours.hour_text(F.col("opening_time"), default_opening)).alias("opens"),
        hours.minute_rank(hours.hour_text(F.col("closing_time"), default_closing)).alias("closes"),
    )
    folded = listings.groupBy("device").agg(
        F.count(F.lit(1)).alias("listings"),
        F.min("opens").alias("opens"),
        F.min("closes").alias("closes"),
        ((F.min("opens") != F.max("opens")) | (F.min("closes") != F.max("closes"))).alias("mixed"),
    )
    size = folded.agg(
        F.coalesce(F.sum(F.octet_length("device") + F.lit(ROW_BYTES)), F.lit(0)).alias("bytes"),
        F.count_if("mixed").alias("mixed"),
    ).first()

    if size["mixed"]:
        folded = _folded_by_minute(listings)
    else:
        folded = folded.withColumn("open_by_minute", F.lit(None).cast("array<bigint>"))
    return DeviceHours(
        folded.select("device", "listings", "opens", "closes", "open_by_minute"),
        size["bytes"] + size["mixed"] * PER_MINUTE_BYTES,
        hours.text_rank(default_opening),
        hours.text_rank(default_closing),
    )


def _folded_by_minute(listings: DataFrame) -> DataFrame:
    """As ``folded``, with a per-minute array where listings disagree.

    Each distinct pair of hours adds its listings at the opening minute and takes them away at the
    closing one. Added up per minute that leaves at most 1,441 changes per device, whatever the
    number of listings; their running total is the number of open listings up to the next change.
    """
    spans = listings.groupBy("device", "opens", "closes").agg(F.count(F.lit(1)).alias("n"))
    change = F.when(F.col("opens") < F.col("closes"), F.col("n")).otherwise(F.lit(0))
    steps = spans.select(
        "device",
        F.inline(
            F.array(
                F.struct(
                    F.col("opens").alias("minute"),
                    change.alias("change"),
                    F.col("n").alias("listings"),
                    F.lit(1).alias("spans"),
                ),
                F.struct(
                    F.col("closes").alias("minute"),
                    (-change).alias("change"),
                    F.lit(0).cast("bigint").alias("listings"),
                    F.lit(0).alias("spans"),
                ),
            )
        ),
    )
    changes = steps.groupBy("device", "minute").agg(
        *[F.sum(name).alias(name) for name in ("change", "listings", "spans")]
    )
    in_order = Window.partitionBy("device").orderBy("minute")
    until = F.lead("minute", 1, hours.MINUTES_PER_DAY).over(in_order)
    segments = changes.select(
        "*",
        F.sum("change").over(in_order).alias("open"),
        (until - F.col("minute")).alias("length"),
    )
    by_device = segments.groupBy("device").agg(
        F.sum("listings").alias("listings"),
        F.min(F.when(F.col("change") > 0, F.col("minute"))).alias("opens"),
        F.max(F.when(F.col("change") < 0, F.col("minute"))).alias("closes"),
        F.sum("spans").alias("spans"),
        F.min("minute").alias("first"),
        F.sort_array(F.collect_list(F.struct("minute", "open", "length"))).alias("segments"),
    )
    before = F.array_repeat(F.lit(0).cast("bigint"), F.col("first"))
    runs = F.transform("segments", lambda run: F.array_repeat(run["open"], run["length"]))
    by_minute = F.concat(before, F.flatten(runs))
    return by_device.withColumn("open_by_minute", F.when(F.col("spans") > 1, by_minute))


def join_hours(plays: DataFrame, devices: DeviceHours, broadcast: bool) -> DataFrame:
    """Left join of plays to their device's hours; never changes the number of rows.

    A broadcast leaves the plays where they are. Otherwise both sides are shuffled by device and
    salt. The plays are stored on the way, and the same pass tells which devices have more of them than
    a task should get; these alone are dealt over several salts, and their rows of the device table repeated.
    Salts are drawn by the group keys, where plays have them, so that counting by the keys and the ``salt`` needs no
    further shuffle. Plays without a device match nothing and take any salt.
    """
    on = F.col("device_id") == F.col("device")
    if broadcast:
        return plays.join(F.broadcast(devices.frame), on, "left")
    plays, busy = find_busy(plays)
    drawn = F.xxhash64(*(KEYS if set(KEYS) <= set(plays.columns) else plays.columns))
    one = F.lit(1).cast("bigint")
    table = devices.frame
    if busy:
        salts = plays.sparkSession.createDataFrame(busy, "busy string, salts bigint")
        plays = plays.join(F.broadcast(salts), F.col("device_id") == F.col("busy"), "left").drop("busy")
        table = table.join(F.broadcast(salts), F.col("device") == F.col("busy"), "left").drop("busy")
    else:
        plays, table = plays.withColumn("salts", one), table.withColumn("salts", one)
    own = F.pmod(drawn, F.coalesce("salts", one))
    salted = plays.withColumn("salt", F.when(F.col("device_id").isNull(), drawn).otherwise(own)).drop("salts")
    last = F.coalesce("salts", one) - 1
    repeated = table.withColumn("device_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("salts")
    return salted.join(repeated.hint("merge"), on & (F.col("salt") == F.col("device_salt")), "left")


def find_busy(plays: DataFrame) -> tuple[DataFrame, list[tuple[str, int]]]:
    """The plays, stored, and each device that has more of them than a task's share, with the tasks it takes.

    Found by a sketch of frequent items that the writing of the plays fills, of bounded size whatever there is.
    Only how the plays are dealt depends on it, not what comes out.
    """
    spark = plays.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen, place = Observation(), scratch_path(spark, "plays")
    top = F.expr(f"approx_top_k(device_id, {BUSY_DEVICES}, {TRACKED_DEVICES})")
    plays.observe(seen, F.count(F.lit(1)).alias("rows"), top.alias("top")).write.parquet(place)
    share = max(1, seen.get.get("rows", 0) // tasks)
    found = [(row["item"], row["count"]) for row in seen.get.get("top") or [] if row["item"] is not None]
    busy = [(device, min(tasks, -(-count // share))) for device, count in found if count > share]
    return spark.read.schema(plays.schema).parquet(place), busy


def listing_weight() -> Column:
    """Joined rows a play stands for: its device's listings, or one when it has none."""
    return F.coalesce(F.col("listings"), F.lit(1))


def open_weight(devices: DeviceHours) -> Column:
    """How many of those are open at the play's minute; unlisted devices keep default hours."""
    minute = F.col("minute")

    def within(opens: Column, closes: Column, weight: Column) -> Column:
        return F.when((minute >= opens) & (minute < closes), weight).otherwise(F.lit(0))

    default = within(F.lit(devices.default_opens), F.lit(devices.default_closes), F.lit(1))
    return (
        F.when(F.col("listings").isNull(), default)
        .when(
            F.col("open_by_minute").isNull(),
            within(F.col("opens"), F.col("closes"), F.col("listings")),
        )
        .otherwise(F.get(F.col("open_by_minute"), minute))
    )
