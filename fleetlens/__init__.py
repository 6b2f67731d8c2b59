"""Analytics for event streams from fleets of connected devices, on Spark.

Every function takes and returns DataFrames or Columns; the same code serves
batch tables and Structured Streaming.
"""
