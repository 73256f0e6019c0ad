"""Instalment-credit analytics as Spark DataFrame jobs."""
