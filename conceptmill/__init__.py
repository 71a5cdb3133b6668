"""Assign controlled-vocabulary concepts to documents with Spark."""
