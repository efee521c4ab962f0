"""Change-data and stream analytics operators on Spark DataFrames."""
