"""Cohort analytics on Spark: profile, clean, merge, audit, features, split, scale, evaluate, score."""

__version__ = "0.1.0"
