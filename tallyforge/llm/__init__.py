"""Training-data operators: packing, deduplication, archives, quality, privacy, tokens.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; the registered queries over the given tables are in
``queries.py``.
"""
