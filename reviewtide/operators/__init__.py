"""Operators on DataFrames: joins, aggregates, filters, layout and checks."""
