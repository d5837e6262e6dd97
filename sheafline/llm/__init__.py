"""Operators for building training corpora, their queries and their SQL.

Nothing outside this package imports it. `__spark_entry__` adds `queries.QUERIES` and
`queries.ORACLE` when the package is there.
"""
