"""Operators for preparing language-model training data.

Each module holds one operator with a general ``DataFrame -> DataFrame``
interface; ``registry`` derives the registered queries from them.  Nothing
outside this folder imports it.
"""
