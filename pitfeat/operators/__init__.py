"""Operators: windowed aggregates, lookups, SCD-2, data quality, reshaping."""
