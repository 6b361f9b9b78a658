"""Market-chatter analytics on Spark DataFrames."""
