"""Recurring-transaction detection and prediction as Spark DataFrame jobs."""
