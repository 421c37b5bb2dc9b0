"""Training-data operators: scans, deduplication, tokens, mixing, search, filters.

Nothing else in ``billflow`` imports this subpackage. Every operator takes its
column names as parameters, reads only those columns (extra columns of any name
are ignored unless an operator says it keeps them) and accepts empty tables.
"""
