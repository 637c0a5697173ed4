"""Cut gridded and river-network tables down to a watershed, on Spark DataFrames."""
