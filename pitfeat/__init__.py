"""Point-in-time behavioural features over Spark DataFrames."""
