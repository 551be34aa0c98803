"""Operators of a training-data pipeline over a ``documents`` table.

One module per operator; each takes a DataFrame with an id and a text column
and ignores any other column, so extra or clashing names do no harm.
:mod:`sprout.llm.queries` binds them to the given tables.
"""
