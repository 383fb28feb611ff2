"""Bike-share trip analytics as Spark DataFrame queries."""
