"""Operators of a training-data pipeline over ``documents``, ``pages`` and
``embeddings``.  Each module holds one operator; ``queries`` registers them."""
