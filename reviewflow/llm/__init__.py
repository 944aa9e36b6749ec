"""Operators of a training-data pipeline over the tables documents, labels and embeddings.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` registers one query per operator.
"""
