"""Operators for large training-data pipelines (documents, pages, conversations).

Nothing else in the library imports this subpackage.  ``registry`` holds the
registered queries and their SQL.
"""
