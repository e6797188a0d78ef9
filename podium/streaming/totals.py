"""Running speaker totals over a stream of segments, each key counted once within the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.plans.base import label_of
from podium.sources.tables import millis


def speaker_totals(stream: DataFrame, delay: str = "40 days") -> DataFrame:
    """(meeting_id, label, segments, speech_ms), updated as segments arrive; works on a batch as well."""
    arrived = stream.withColumn("arrived", F.col("ingested_at").cast("timestamp")).withWatermark("arrived", delay)
    one = arrived.dropDuplicatesWithinWatermark(["meeting_id", "segment_id"]) if stream.isStreaming else arrived.dropDuplicates(["meeting_id", "segment_id"])
    start, end = millis("start_time"), millis("end_time")
    return one.groupBy("meeting_id", label_of().alias("label")).agg(F.count(F.lit(1)).alias("segments"), F.sum(F.when(end > start, end - start).otherwise(0)).alias("speech_ms"))
