"""Spark-native analytics over time-coded, multi-speaker transcripts."""
