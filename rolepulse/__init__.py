"""Role activity and churn analytics for game event logs, on Spark DataFrames."""
