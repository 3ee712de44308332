"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each operator lives in a module of its own,
`queries.py` applies the operators to the corpus tables, and `sql.py` holds their DuckDB oracles.
"""
