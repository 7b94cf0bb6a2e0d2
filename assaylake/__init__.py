"""Rule-driven data quality and medallion loads on Spark DataFrames."""
