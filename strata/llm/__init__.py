"""Operators for training-data pipelines.

Nothing else in the library imports this subpackage.  One module per operator; ``tokens``, ``chunks`` and
``components`` hold what they share; ``queries`` binds them to the driver's tables.
"""
