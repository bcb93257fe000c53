"""Dialogue analytics on Spark."""
