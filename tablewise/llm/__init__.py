"""Operators for large-scale training-data pipelines.

Ten operators, one module each, over tables of documents, pages and
conversations.  Nothing else in the library imports this subpackage; its
queries are registered in :mod:`tablewise.llm.queries`.
"""
