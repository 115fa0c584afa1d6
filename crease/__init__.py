"""Spark-native ball-by-ball cricket analytics.

Nested match documents and keyed ball messages are read with the DataFrame
reader, flattened on the executors, cleaned, and rolled up into leaderboards,
phase / venue / match summaries, warehouse tables, a partitioned lake table and
running scorecards -- in batch and with Structured Streaming.
"""

__version__ = "0.1.0"
