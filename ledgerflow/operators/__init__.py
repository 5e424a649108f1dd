"""Operators: DataFrame in, DataFrame out, no action on the way unless the docstring says so."""
