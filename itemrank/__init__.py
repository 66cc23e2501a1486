"""itemrank: Spark-native rating analytics and item recommendation.

Sub-packages
------------
sources    readers for the rating / movie / user tables, fixture views, model store
functions  column expressions (title parsing, tokenising, fuzzy score, time decay)
operators  DataFrame operators (stats, search, kNN, recommendations, evaluation)
plans      the named query catalogue and the DuckDB oracle SQL for each query
streaming  Structured Streaming ingestion of rating events
"""

__version__ = "0.1.0"
