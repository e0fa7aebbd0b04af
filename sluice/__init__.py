"""Data-pipeline and data-quality building blocks on Spark DataFrames."""
