"""Queries over the driver tables: trees, catalogues and labels derived from them, in Spark and in SQL."""
