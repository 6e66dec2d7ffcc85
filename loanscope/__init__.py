"""Credit-portfolio analytics on Spark DataFrames."""
