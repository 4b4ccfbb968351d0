"""Readers: landed JSON, XML and CSV files to typed DataFrames."""
