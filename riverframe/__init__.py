"""Time-series feature, extreme-event and evaluation operators on Spark DataFrames."""
