"""Quality control, anomaly and series analytics on Spark DataFrames."""
