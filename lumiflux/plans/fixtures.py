"""Tables of the test data read as movies, atlases and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from lumiflux.operators import masks, trials
from lumiflux.operators.frames import by_channel, grid, separate_channels, temporal, to_pixels

SIDE = 8
ORDER = ("green", "red", "blue")
BASELINE = (10, 100)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as interleaved frames of 8 x 8 pixels, lifted above 0."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame"), F.transform("embedding", lambda e: e.cast("double") + 2.0).alias("img"))


def n_frames(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "embeddings").count()


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """channel, t, y, x, v."""
    return separate_channels(to_pixels(frames(spark, sf_dir), SIDE), n_frames(spark, sf_dir), ORDER).select("channel", "t", "y", "x", "v")


def trial_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trial, channel, t, y, x, v: even and odd vectors as two trials."""
    rows = frames(spark, sf_dir).select((F.col("frame") % 2).cast("int").alias("trial"), F.floor(F.col("frame") / 2).cast("long").alias("frame"), "img")
    return to_pixels(trials.separate(rows, ORDER), SIDE).select("trial", "channel", "t", "y", "x", "v")


def channel(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One channel. The filter on the frame number reaches the scan."""
    k, whole = ORDER.index(name), 3 * (n_frames(spark, sf_dir) // 3)
    own = frames(spark, sf_dir).where((F.col("frame") % 3 == k) & (F.col("frame") < whole))
    return to_pixels(own.withColumn("t", F.floor(F.col("frame") / 3).cast("long")).drop("frame"), SIDE).select("t", "y", "x", "v")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t, y, x, green, red, blue."""
    return by_channel(channels(spark, sf_dir), ORDER)


def atlas(spark: SparkSession) -> DataFrame:
    """Rows 0 and 7 are background, the rest four quadrants."""
    y, x = F.col("y"), F.col("x")
    label = F.when(y.isin(0, SIDE - 1), 0).otherwise(1 + (x >= 4).cast("int") + 2 * (y >= 4).cast("int"))
    return grid(spark, SIDE, SIDE).withColumn("label", label.cast("int"))


def mask(spark: SparkSession) -> DataFrame:
    """A view that cuts the atlas: columns 1 to 5."""
    return grid(spark, SIDE, SIDE).where("x between 1 and 5")


def mean_image(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return temporal(channel(spark, sf_dir, name), "mean")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An atlas drawn from the movie: the label of a pixel is the fifth of the mean blue image that it lies in, from 0."""
    image = mean_image(spark, sf_dir, "blue")
    cuts = image.agg(F.percentile("v", F.array(*map(F.lit, (0.2, 0.4, 0.6, 0.8)))).alias("cuts"))
    label = F.size(F.filter("cuts", lambda c: F.col("v") > c))
    return image.crossJoin(F.broadcast(cuts)).select("y", "x", label.cast("int").alias("label"))  # a single row


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mask drawn from the movie: the brighter six tenths of the mean green image."""
    return masks.by_percentile(mean_image(spark, sf_dir, "green"), 40)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point of the 8 x 8 view for each nation: the balances of its first and its last customer; g is its region."""
    at = lambda f: (f("c_acctbal", "c_custkey") + 1000) / 11000 * SIDE
    points = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(at(F.min_by).alias("x"), at(F.max_by).alias("y"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("g"))
    return nations.join(points, "k")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as traces: label is the user, t counts its events. Every fifth user is lowered by 60, which leaves little
    signal; every seventh, from 3, drifts by 10 an event."""
    t = F.row_number().over(W.partitionBy("user_id").orderBy("event_id")) - 1
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("label"), t.cast("long").alias("t"), F.col("value").alias("v"))
    return rows.withColumn("v", F.col("v") - F.when(F.col("label") % 5 == 0, 60.0).otherwise(0.0) + F.when(F.col("label") % 7 == 3, 10.0 * F.col("t")).otherwise(0.0))
