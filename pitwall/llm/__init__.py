"""Operators for preparing training text, each a Spark job over a table.

Nothing else in the library imports this subpackage."""
