"""Operators of a training-data pipeline over corpora of documents, vectors and chats.

Nothing else in the library imports this subpackage.
"""
