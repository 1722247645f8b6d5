"""Rental-listing analytics expressed as Spark DataFrame jobs."""
