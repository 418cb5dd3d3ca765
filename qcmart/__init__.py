"""qcmart: batch analytics for quick-commerce orders, built on Spark DataFrames."""
