"""Queries over the driver tables, and the build of all table layouts."""
