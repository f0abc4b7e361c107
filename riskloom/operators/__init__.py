"""Operators: DataFrames and parameters in, a lazy DataFrame out unless a docstring says otherwise."""
