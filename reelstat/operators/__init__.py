"""Operators: DataFrame in, DataFrame out (splits, positions, profile, model steps, bias fit)."""
