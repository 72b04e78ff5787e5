"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage.  Every operator takes a
DataFrame of documents (an id column, a text column, any others) and returns a
DataFrame; wide intermediate results are staged as Parquet below the session's
shared checkpoint folder.
"""
