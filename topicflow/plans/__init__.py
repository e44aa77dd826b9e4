"""Registered reports over the driver tables: Spark plans and their SQL twins."""
