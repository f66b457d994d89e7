"""Operators for large training-data pipelines (text and embeddings).

Nothing outside this subpackage imports it. Each module holds one operator with a
general interface; ``queries.py`` registers the thin ``opN_`` queries over the
driver tables.
"""
