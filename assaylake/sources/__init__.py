"""Inputs and sinks: rule metadata, layered Parquet tables, scratch space."""
