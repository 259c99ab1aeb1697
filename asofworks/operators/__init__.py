"""Operators over DataFrames of facts, cells, prices and edges."""
