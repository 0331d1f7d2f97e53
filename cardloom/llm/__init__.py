"""Training-data operators: dedup, search, mixing, filters, archives and tokenizing.

Nothing else in the library imports this subpackage.
"""
