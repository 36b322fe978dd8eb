"""Readers: landed files and tables to raw-layer DataFrames."""
