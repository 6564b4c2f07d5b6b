"""Operators: DataFrame in, DataFrame out, lazy unless the name says otherwise."""
