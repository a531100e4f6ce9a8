"""Churn-pipeline data work as Spark jobs: profile, clean, featurise, split, score, gate and watch for drift."""

__version__ = "0.1.0"
