"""Operators for large-scale training-data preparation.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder can be imported.  ``catalog.queries`` lists the contract
queries and ``catalog.oracle_sql`` their SQL twins where SQL can express them.
"""
