"""Operators for preparing training text at corpus scale, each on DataFrames of documents."""
