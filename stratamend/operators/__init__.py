"""Operators over DataFrames of record versions, keys and catalogs."""
