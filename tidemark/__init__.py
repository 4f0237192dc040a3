"""Event-time analytics over behaviour streams, on Spark DataFrames."""
