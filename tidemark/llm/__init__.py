"""Operators for preparing text corpora for language-model training.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
``DataFrame -> DataFrame`` interface; :mod:`tidemark.llm.registry` holds the thin registered queries.
"""
