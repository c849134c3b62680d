"""lakeward: a Spark-native toolkit that takes raw tabular data from landing
files to trusted tables (landing zone, quality gates, table maintenance and
bronze/silver/gold promotion, in batch or with Structured Streaming)."""

__version__ = "0.1.0"
