"""Operators for large-scale training-data preparation.

Nothing else in the package imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` registers one thin
query per operator and ``sql.py`` holds the DuckDB text where SQL can say it.
"""
