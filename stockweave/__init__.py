"""Supply-chain analytics on Spark DataFrames."""
