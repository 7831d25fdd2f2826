"""Operators of a training-data pipeline over text corpora, chats, URLs and embeddings.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
