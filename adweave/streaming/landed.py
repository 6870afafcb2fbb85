"""Landed ads and their stats joined while both still arrive.

The batch extract joins what has landed when it runs. Here two streams meet: an ad's row is
emitted with each of its stats as they land, and alone once so much time has passed that no
stats can follow. Time is the moment a response landed, not the day it speaks of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.sources import payloads as P

LANDED = f"{S.LANDING}, landed_at timestamp"


def watch_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Responses as they land: Parquet files in the LANDING layout with ``landed_at``."""
    return spark.readStream.schema(LANDED).parquet(folder)


def ads_outer_stats(ads: DataFrame, stats: DataFrame, wait: str = "1 day",
                    late: str = "1 hour") -> DataFrame:
    """Stream of ads LEFT OUTER JOIN stats, by ad and within ``wait`` of the ad's landing.

    A response is one row until it has met its ad, so state holds responses, not their days, and of
    those a JSON text with the metrics that are there: a row has eight bytes for each that is not.

    Responses later than ``late`` behind the newest one are ignored. State holds the ads and
    stats of the last ``wait`` and ``late``, then lets them go; an ad without stats comes out
    with empty metrics when it goes. An ad that lands again within ``late`` is the same ad.
    """
    left = P.read_entity(ads, "ad", keep=["landed_at"]).withWatermark("landed_at", late) \
        .dropDuplicatesWithinWatermark(["ad_id"]).withColumnRenamed("landed_at", "ad_landed_at") \
        .drop("account_id").alias("a")
    found = P.read_day_series(stats, keep=["landed_at"])
    days = found.schema["series"].dataType
    right = found.withColumn("series", F.to_json("series")).withWatermark("landed_at", late) \
        .withColumnRenamed("landed_at", "stats_landed_at").drop("window_start").alias("s")
    near = (F.col("a.ad_id") == F.col("s.ad_id")) & F.expr(
        f"s.stats_landed_at between a.ad_landed_at and a.ad_landed_at + interval {wait}")
    both = left.join(right, near, "left_outer").drop(F.col("s.ad_id"))
    return both.select(*[c for c in both.columns if c != "series"], F.inline_outer(F.from_json("series", days)))
