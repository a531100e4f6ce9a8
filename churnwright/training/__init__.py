"""Training, tuning and scoring with Spark ML."""
