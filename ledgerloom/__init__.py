"""Credit-risk data preparation on Spark: staging, validation, history, features, monitoring."""
