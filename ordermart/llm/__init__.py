"""Operators for preparing training data at scale.

Each module holds one operator with its own general interface; ``catalog``
registers the thin contract queries and ``corpus_pipeline.py`` (repository
top) chains five of them.  Nothing outside this package imports it.
"""
