"""Training-data operators: one module per operator, ``registry`` for the queries.

Nothing else in the library imports this subpackage.
"""
