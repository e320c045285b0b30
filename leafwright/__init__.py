"""leafwright: page-document analytics on Spark DataFrames."""
