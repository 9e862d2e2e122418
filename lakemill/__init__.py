"""Medallion and data-quality transforms as plain Spark DataFrame functions."""
