"""Ordered events, half-open ranges and their analytics on Spark."""
