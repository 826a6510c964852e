"""Training-data operators: one module per operator, Spark jobs throughout.

Nothing else in the library imports this subpackage.
"""
