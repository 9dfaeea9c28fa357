"""Readers. All return DataFrames; nothing is read on the driver."""
