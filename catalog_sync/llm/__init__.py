"""Operators of a training-data pipeline (dedup, counting, search, packing, scoring, filtering, formats).

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``registered`` holds the thin queries.
"""
