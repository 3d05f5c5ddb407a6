"""Operators for preparing training text: one module per operator.

Nothing outside this package imports it; ``__spark_entry__.py`` adds
``queries.QUERIES`` when the package is present.
"""
