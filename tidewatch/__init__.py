"""Temporal feature and risk-scoring engine built from Spark DataFrame plans."""
