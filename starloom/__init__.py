"""Star-schema analytics and data quality on Spark DataFrames."""
