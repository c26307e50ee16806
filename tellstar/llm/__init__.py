"""Operators of a training-data pipeline over the tables ``documents``, ``labels``,
``benchmark`` and ``embeddings``. Nothing else in the library imports this subpackage."""
