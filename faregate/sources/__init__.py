"""Readers: tables in several formats, Spark event logs."""
