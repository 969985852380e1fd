"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Every module holds one
operator with a general interface; ``queries`` binds them to the synthetic
tables and adds the SQL that can check them.
"""
