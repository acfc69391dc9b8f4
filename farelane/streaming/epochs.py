"""The five-minute epoch over a stream: counts and mean travel time by map segment, with a watermark for late observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import EPOCH_SECONDS


def epoch_traffic(observations: DataFrame, late: str = "30 minutes") -> DataFrame:
    """observations (batch or stream): ts, conflation_map_id, travel_time. State is kept for a window until the watermark passes it."""
    window = F.window("ts", f"{EPOCH_SECONDS} seconds")
    rows = observations.withWatermark("ts", late) if observations.isStreaming else observations
    out = rows.groupBy(window, "conflation_map_id").agg(F.count("*").alias("n"), F.avg("travel_time").alias("avg_travel_time"))
    return out.select("conflation_map_id", F.col("window.start").alias("epoch_start"), "n", "avg_travel_time")
