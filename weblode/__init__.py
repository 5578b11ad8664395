"""Index, rank and search crawled web pages with Spark DataFrames."""
