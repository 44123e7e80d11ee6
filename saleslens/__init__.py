"""saleslens: sales and customer analytics on Spark DataFrames."""
