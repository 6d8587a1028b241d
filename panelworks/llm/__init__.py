"""Operators for training-data pipelines; nothing else in the package imports this one.

Operators on documents expect the columns ``doc_id``, ``text`` and, where they say so,
``source`` or ``lang``; they read no other column, so further columns of any name are
ignored unless a function returns the rows of its input.
"""
