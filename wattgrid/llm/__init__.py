"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present."""
