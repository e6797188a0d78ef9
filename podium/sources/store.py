"""Stores that are replaced as a whole: versions in folders, and a pointer file that names the current one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGES = ["none", "ingested", "diarized", "transcribed", "identified", "summarized", "enrolled", "exported"]
_STATE = "meeting_id string, completed_stage int, transcription_progress int, total_segments int"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


_POINTER = "_current"


def _version(spark: SparkSession, path: str) -> str | None:
    """The folder that the pointer file names; null where there is no store."""
    fs, Path = _fs(spark, path)
    pointer = Path(f"{path}/{_POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def replace(df: DataFrame, path: str) -> None:
    """Writes df as a new version beside the old one, then points to it; df may read the old one.

    The pointer is one small file written over at once, so a reader finds the old version or the new
    one. The version before the new one stays for readers that have begun; older ones are removed.
    """
    spark = df.sparkSession
    fs, Path = _fs(spark, path)
    before, new = _version(spark, path), f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{new}")
    out = fs.create(Path(f"{path}/{_POINTER}"), True)
    try:
        out.write(bytearray(new, "utf-8"))
    finally:
        out.close()
    for status in fs.listStatus(Path(path)):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (before, new):
            fs.delete(status.getPath(), True)


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The store, or an empty one where there is none yet."""
    current = _version(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{current}") if current else spark.createDataFrame([], schema)


def mark_complete(spark: SparkSession, path: str, meetings: DataFrame, stage: str) -> None:
    """Records that the meetings (meeting_id) have completed the stage; a meeting's other state stays."""
    state = load_state(spark, path)
    done = meetings.select("meeting_id").distinct().withColumn("new", F.lit(STAGES.index(stage)))
    both = state.join(done, "meeting_id", "full")
    replace(both.select("meeting_id", F.coalesce("new", "completed_stage").alias("completed_stage"), F.coalesce("transcription_progress", F.lit(0)).alias("transcription_progress"), F.coalesce("total_segments", F.lit(0)).alias("total_segments")), path)


def update_progress(spark: SparkSession, path: str, progress: DataFrame) -> None:
    """Records (meeting_id, transcription_progress, total_segments); the completed stage stays."""
    state = load_state(spark, path)
    new = progress.select("meeting_id", F.col("transcription_progress").cast("int").alias("p"), F.col("total_segments").cast("int").alias("t"))
    both = state.join(new, "meeting_id", "full")
    replace(both.select("meeting_id", F.coalesce("completed_stage", F.lit(0)).alias("completed_stage"), F.coalesce("p", "transcription_progress").alias("transcription_progress"), F.coalesce("t", "total_segments").alias("total_segments")), path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return load(spark, path, _STATE)


def is_complete(state: DataFrame, stage: str) -> DataFrame:
    """The meetings that have completed the stage."""
    return state.where(f"completed_stage >= {STAGES.index(stage)}").select("meeting_id")
