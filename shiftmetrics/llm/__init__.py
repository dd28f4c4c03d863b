"""Operators for training-data pipelines (texts, tokens, shards).

Each module holds one operator with its own interface; ``queries`` binds the
operators to the tables ``documents``, ``labels`` and ``benchmark``.
"""
