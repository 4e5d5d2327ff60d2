"""Classifiers on Spark ML and exact DataFrame formulations."""
