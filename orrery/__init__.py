"""Analytics operators over Spark DataFrames."""
